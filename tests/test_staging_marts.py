import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import frames as t
from ledgermill.operators import marts, staging
from ledgermill.plans import models


def test_amount_band_edges_and_null(spark):
    rows = [(i, 1, "2024-02-17", a, " dining ", "HISTORICAL") for i, a in
            enumerate(["5000.00", "5000.01", "1000.00", "1000.01", "-3.00", None])]
    found = staging.stg_transactions(t.transactions(spark, *rows)).orderBy("transaction_id").collect()
    assert [r.amount_category for r in found] == ["Medium", "High", "Low", "Medium", "Low", "Low"]
    assert found[0].transaction_month == dt.date(2024, 2, 1)
    assert found[0].transaction_type == "DINING"


def test_trim_strips_spaces_only(spark):
    staged = staging.stg_customers(t.customers(spark, (1, None, "\tann ", " o'b ", "(212) 555-0101")))
    row = t.one(staged)
    assert row.first_name == "\tANN"
    assert (row.last_name, row.phone_clean, row.has_mortgage) == ("O'B", "2125550101", False)


def test_ratio_is_loan_over_income(spark):
    staged = staging.stg_mortgages(
        t.mortgages(spark, t.mortgage(1, income="0", loan="200"), t.mortgage(2, income="8", loan="1"),
                    t.mortgage(3, income="3", loan="200.00")))
    found = {r.loan_record_id: r for r in staged.collect()}
    assert found[1].debt_to_income_ratio is None
    assert found[2].debt_to_income_ratio == Decimal("0.13")  # 0.125, half away from zero
    assert found[3].debt_to_income_ratio == Decimal("66.67")
    assert found[3].applicant_income == 3000 and found[3].loan_amount == 200000


def _360(spark, customers, mortgages, transactions, role="data_steward"):
    return models.customer_360(models.staging_models(models.Raw(customers, mortgages, transactions), role))


def test_customer_without_transactions(spark):
    found = _360(
        spark,
        t.customers(spark, (1, 5, "a", "b", "1"), (2, None, "c", "d", "2")),
        t.mortgages(spark, t.mortgage(5)),
        t.transactions(spark, (1, 9, "2024-01-01", "5.00", "x", "HISTORICAL")),
    )
    for row in found.collect():
        assert (row.total_transactions, row.active_months) == (0, 0)
        assert row.total_spent is None and row.avg_transaction is None and row.last_transaction_date is None
        assert row.customer_tier == "Basic"
    segments = t.rows(marts.customer_segments(found), "customer_segment", "customer_count", "avg_total_spent",
                      "mortgage_percentage")
    assert segments == [("Basic Mortgage", 1, None, Decimal("100.0")), ("Basic Non-Mortgage", 1, None, Decimal("0.0"))]


def test_tier_edges(spark):
    found = _360(
        spark,
        t.customers(spark, *[(i, None, "a", "b", "1") for i in range(4)]),
        t.mortgages(spark),
        t.transactions(spark, *[(i, i, "2024-01-01", a, "x", "HISTORICAL") for i, a in
                                enumerate(["50000.00", "50000.01", "15000.00", "15000.01"])]),
    )
    assert t.rows(found, "customer_id", "customer_tier") == [
        (0, "Standard"), (1, "Premium"), (2, "Basic"), (3, "Standard")]


def test_empty_inputs(spark):
    empty = _360(spark, t.customers(spark), t.mortgages(spark), t.transactions(spark))
    assert empty.count() == 0
    assert marts.customer_segments(empty).count() == 0
    assert marts.transaction_summary(staging.stg_transactions(t.transactions(spark))).count() == 0


def _join_then_group(customers, mortgages, transactions):
    """Customer 360 in plain Python: full join first, groups afterwards."""
    groups = defaultdict(list)
    for cid, loan, first, last, phone in customers:
        loans = [m for m in mortgages if m[0] is not None and m[0] == loan] or [None]
        own = [x for x in transactions if x[1] == cid] or [None]
        for m in loans:
            values = (None,) * 2 if m is None else (m[8] * 1000, m[7] * 1000)
            county = None if m is None else m[9].strip().upper()
            key = (cid, first.upper(), last.upper(), phone, loan is not None, *values, county)
            groups[key].extend(own)
    result = []
    for key, joined in groups.items():
        present = [x for x in joined if x is not None]
        amounts = [Decimal(x[3]) for x in present]
        result.append((*key, len(present), sum(amounts) if amounts else None,
                       max((dt.date.fromisoformat(x[2]) for x in present), default=None),
                       len({x[2][:7] for x in present})))
    return sorted(result, key=repr)


def test_customer_360_equals_join_then_group_with_copies(spark):
    """Repeated customers and mortgages, shared and unknown loans, one customer with a third of all rows."""
    pick = random.Random(3)
    customers, mortgages, transactions = [], [], []
    for cid in range(12):
        row = (cid, pick.choice([None, None, 1, 1, 2, 3, 99]), "n%d" % cid, "l", "555")
        customers += [row] * pick.choice([1, 1, 2])
    customers.append((0, 2, "n0", "l", "555"))
    for key in (1, 1, 1, 2, 2, 3, None):
        mortgages.append(t.mortgage(key, loan=pick.choice(["100", "200"]), income="10", county=pick.choice(["a", "b"])))
    for tid in range(90):
        cid = 4 if tid % 3 == 0 else pick.randrange(14)
        day = f"2024-{pick.randrange(1, 13):02d}-{pick.randrange(1, 28):02d}"
        transactions.append((tid, cid, day, f"{pick.randrange(100, 900000) / 100:.2f}", "x", "HISTORICAL"))
    found = _360(spark, t.customers(spark, *customers), t.mortgages(spark, *mortgages),
                 t.transactions(spark, *transactions))
    columns = ["customer_id", "first_name", "last_name", "phone_clean", "has_mortgage", "loan_amount",
               "applicant_income", "county", "total_transactions", "total_spent", "last_transaction_date",
               "active_months"]
    assert t.rows(found, *columns) == _join_then_group(customers, mortgages, transactions)


def test_masked_values_stay_in_marts(spark):
    raw = (t.customers(spark, (1, None, "ann", "bell", "(212) 555-0101")), t.mortgages(spark), t.transactions(spark))
    hidden = t.one(_360(spark, *raw, role=None))
    assert (hidden.last_name, hidden.phone_clean) == ("***", "0101")
    shown = t.one(_360(spark, *raw, role="Data_Steward"))
    assert (shown.last_name, shown.phone_clean) == ("BELL", "2125550101")


def test_transaction_summary_counts_bands(spark):
    staged = staging.stg_transactions(t.transactions(
        spark,
        (1, 1, "2024-01-01", "6000.00", "Dining", "HISTORICAL"),
        (2, 1, "2024-01-31", "2000.00", " dining", "HISTORICAL"),
        (3, 1, "2024-01-15", "1.00", "DINING ", "HISTORICAL"),
        (4, 1, "2024-02-01", "1.00", "DINING ", "HISTORICAL"),
    ))
    found = marts.transaction_summary(staged).orderBy("transaction_month").collect()
    assert [(r.transaction_count, r.high_value_count, r.medium_value_count, r.low_value_count) for r in found] == [
        (3, 1, 1, 1), (1, 0, 0, 1)]
    assert found[0].total_amount == Decimal("8001.00") and found[0].avg_amount == Decimal("2667.000000")


def test_published_models(spark):
    raw = models.Raw(
        t.customers(spark, (1, 5, "a", "b", "1"), (2, None, "c", "d", "2")),
        t.mortgages(spark, t.mortgage(5), t.mortgage(None)),
        t.transactions(spark, (1, 1, "2024-01-01", "5.00", "x", "HISTORICAL")))
    published = models.publish(spark, raw, mart_schema=" analytics ")
    assert published["customer_360"] == "ANALYTICS.customer_360"
    assert published["stg_customers"] == "stg_customers"
    assert spark.sql("SELECT count(*) AS n FROM analytics.customer_360").first().n == 2
    assert spark.sql("SELECT count(*) AS n FROM stg_customers").first().n == 2
    assert spark.table("analytics.mortgage_base").count() == 1
    assert models.schema_for(None, "TRANSFORMED") == "TRANSFORMED"


def test_bucketed_profile_joins_without_shuffling_it(spark):
    import contextlib
    import io

    raw = models.Raw(t.customers(spark, (1, None, "a", "b", "1")), t.mortgages(spark), t.transactions(spark))
    published = models.publish(spark, raw, mart_schema="bucketed", buckets=4)
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        spark.table(published["customer_360"]).groupBy("customer_id").count().explain()
    assert "Exchange" not in text.getvalue()


def test_means_and_shares_are_exact_at_any_count(spark):
    from decimal import ROUND_HALF_UP, Decimal, localcontext

    from ledgermill.functions import money
    from pyspark.sql import functions as F

    cases = [
        (Decimal(total), rows)
        for rows in (1, 3, 10**12, 10**15, 2**62)
        for total in ("0", "0.01", "-0.05", "10.005".replace("5", ""), str(10**25), str(-(10**25) - 1), str(rows // 2), str(rows * 7 + rows // 2))
    ]
    df = spark.createDataFrame([(t, n) for t, n in cases], "total decimal(38,2), n long")
    out = df.select("total", "n", money.mean(F.col("total"), F.col("n")).alias("mean"), money.percent(F.col("n"), F.lit(2**62), 4).alias("share"))
    with localcontext() as context:
        context.prec = 80
        for row in out.collect():
            assert row["mean"] == (row.total / row.n).quantize(Decimal("0.01"), ROUND_HALF_UP), row
            assert row.share == (Decimal(100) * row.n / 2**62).quantize(Decimal("0.0001"), ROUND_HALF_UP)
    none = spark.createDataFrame([(Decimal(10) ** 30, 1), (Decimal(1), 0), (None, 1)], "total decimal(38,2), n long")
    assert [r.m for r in none.select(money.mean(F.col("total"), F.col("n")).alias("m")).collect()] == [None, None, None]
