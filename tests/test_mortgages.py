import datetime as dt
import random

import frames as t
from ledgermill.operators import mortgages
from ledgermill.operators.ordering import newest, with_position
from pyspark.sql import functions as F

LATER = t.NOW + dt.timedelta(seconds=1)


def test_latest_row_per_key(spark):
    found = mortgages.latest_mortgages(t.mortgages(
        spark,
        t.mortgage(1, loan_id="old"), t.mortgage(1, loan_id="new", created=LATER),
        t.mortgage(2, loan_id="b"), t.mortgage(2, loan_id="a"),
        t.mortgage(3, loan_id="dated"), t.mortgage(3, loan_id="undated", created=None),
        t.mortgage(None, loan_id="keyless"), t.mortgage(None, loan_id="keyless"),
        *[t.mortgage(4, loan_id="copy")] * 50,
    ))
    assert t.rows(found, "loan_record_id", "loan_id") == [(1, "new"), (2, "a"), (3, "undated"), (4, "copy")]


def test_text_is_normalised(spark):
    found = mortgages.mortgage_base(t.mortgages(
        spark,
        t.mortgage(1, kind=" FSA/RHS-guaranteed ", purpose=" Home-improve. ment", county=" St. Mary_s-x "),
        t.mortgage(2, kind="VA-guaranteed", purpose="a\tb", county="\tx"),
        t.mortgage(3, kind="va-guaranteed", purpose="", county="-_."),
        t.mortgage(4, kind="FHA-insured", purpose="Re.fi", county="Kings"),
    ))
    assert t.rows(found, "loan_record_id", "loan_type_name", "loan_purpose_name", "county_name") == [
        (1, "FSA_RHS", "_HOME_IMPROVE__MENT", "ST MARYSX"),
        (2, "VA", "A\tB", "\tX"),
        (3, "VA-GUARANTEED", "", ""),
        (4, "FHA", "RE_FI", "KINGS"),
    ]


def test_numbers_follow_text_order(spark):
    found = mortgages.number_mortgages(t.mortgages(
        spark, t.mortgage(None, "10"), t.mortgage(None, "9"), t.mortgage(None, "10", week="2023-01-01"),
        t.mortgage(None, None), t.mortgage(None, "100")))
    numbered = found.select("loan_record_id", "loan_id", F.col("week_start_date").cast("string")).collect()
    assert sorted(tuple(r) for r in numbered) == [
        (1, "10", "2023-01-01"), (2, "10", "2024-01-01"), (3, "100", "2024-01-01"), (4, "9", "2024-01-01"),
        (5, None, "2024-01-01")]


def test_numbers_are_dense_with_a_hot_key_and_copies(spark, shuffle_partitions):
    pick = random.Random(5)
    rows = [t.mortgage(None, "hot" if i % 3 == 0 else str(pick.randrange(400)), loan=str(pick.randrange(3) + 1))
            for i in range(3000)]
    frame = t.mortgages(spark, *rows).repartition(6)
    keyed = sorted((r[3], str(r[8])) for r in rows)
    for partitions in (1, 8):
        shuffle_partitions(partitions)
        found = mortgages.number_mortgages(frame).orderBy("loan_record_id").collect()
        assert [r.loan_record_id for r in found] == list(range(1, 3001))
        assert [r.loan_id for r in found] == [k for k, _ in keyed]


def test_position_of_nothing(spark):
    assert with_position(spark.range(0), [F.col("id")]).count() == 0


def test_newest_equals_plain_top_k(spark):
    pick = random.Random(7)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=pick.choice([0, 0, 1, 2, 5, 9])) for _ in range(400)]
    frame = spark.createDataFrame([(i, day) for i, day in enumerate(days)] + [(999, None)], "id long, day date")
    for rows in (1, 7, 150, 400, 5000):
        found = [tuple(r) for r in newest(frame, "day", rows, [F.col("id").desc()]).collect()]
        plain = sorted(((i, day) for i, day in enumerate(days)), key=lambda r: (r[1], r[0]), reverse=True)[:rows]
        assert found == plain


def test_input_in_unstable_order_is_numbered_once(spark):
    """Rows out of a shuffle, many of them copies: every number once, every row kept."""
    rows = spark.range(5000).select((F.col("id") % 3).alias("k")).repartition(7)
    found = with_position(rows, [F.col("k")]).orderBy("position").collect()
    assert [r.position for r in found] == list(range(5000))
    assert [r.k for r in found] == sorted(i % 3 for i in range(5000))
