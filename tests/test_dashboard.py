import datetime as dt
from decimal import Decimal

import frames as t
from ledgermill.operators import dashboard, staging
from ledgermill.operators.ordering import newest

AS_OF = dt.date(2024, 5, 31)


def _staged(spark):
    return staging.stg_transactions(t.transactions(
        spark,
        (1, 1, "2024-05-31", "10.00", "leisure", "HISTORICAL"),
        (2, 1, "2024-05-01", "20.00", "Business ", "STREAMING"),
        (3, 2, "2024-04-30", "40.00", "leisure", "HISTORICAL"),
        (4, 2, "2024-05-20", "80.00", "education", "HISTORICAL"),
        (5, 2, "2024-05-20", "5.00", "leisure", "HISTORICAL"),
    ))


def test_types_match_in_any_case_and_edges_count(spark):
    shown = dashboard.dashboard_transactions(_staged(spark), AS_OF, 30)
    assert [r.transaction_id for r in shown.collect()] == [1, 5, 2]
    assert shown.columns == ["transaction_id", "customer_id", "transaction_type", "amount", "transaction_date", "description"]


def test_named_periods(spark):
    for name, days in (("Last 7 Days", 7), ("Last Year", 365)):
        by_name = dashboard.dashboard_transactions(_staged(spark), AS_OF, name)
        assert by_name.collect() == dashboard.dashboard_transactions(_staged(spark), AS_OF, days).collect()


def test_no_type_no_rows(spark):
    shown = dashboard.dashboard_transactions(_staged(spark), AS_OF, 365, [])
    assert shown.count() == 0
    assert dashboard.volume_by_type(shown).count() == 0


def test_charts_see_the_whole_selection_and_listings_their_rows(spark):
    chosen = dashboard.chosen_transactions(_staged(spark), AS_OF, 365, ["leisure", "education"])
    assert t.rows(dashboard.volume_by_type(chosen)) == [("EDUCATION", Decimal("80.00")), ("LEISURE", Decimal("55.00"))]
    assert t.rows(dashboard.daily_trends(chosen), "amount", "transaction_count") == [
        (Decimal("10.00"), 1), (Decimal("40.00"), 1), (Decimal("85.00"), 2)]
    assert [r.transaction_id for r in dashboard.recent_transactions(chosen, 2).collect()] == [1, 5]
    shown = dashboard.dashboard_transactions(_staged(spark), AS_OF, 365, ["leisure", "education"], rows=3)
    assert [r.transaction_id for r in shown.collect()] == [1, 5, 4]


def test_newest_rows_out_of_many_tasks(spark):
    from pyspark.sql import functions as F

    rows = spark.range(0, 4000, 1, 23).select("id", F.date_add(F.lit(AS_OF), (-(F.col("id") * 7919 % 3)).cast("int")).alias("day"))
    found = [r.id for r in newest(rows, "day", 50, [F.col("id").desc()]).collect()]
    assert found == sorted((i for i in range(4000) if i * 7919 % 3 == 0), reverse=True)[:50]


def test_summary(spark):
    people = spark.createDataFrame([(1,), (2,), (3,), (3,)], "customer_id long")
    row = t.one(dashboard.dashboard_summary(people, _staged(spark), AS_OF))
    assert tuple(row) == (3, 2, Decimal("115.00"), 4)
    nobody = t.one(dashboard.dashboard_summary(people.limit(0), _staged(spark), AS_OF))
    assert tuple(nobody) == (0, 0, None, 0)


def test_summary_counts_each_copy_of_a_customer(spark):
    people = spark.createDataFrame([(1,), (1,)], "customer_id long")
    assert tuple(t.one(dashboard.dashboard_summary(people, _staged(spark), AS_OF))) == (1, 1, Decimal("60.00"), 4)
