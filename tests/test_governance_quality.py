import datetime as dt
from decimal import Decimal

import frames as t
import pytest
from ledgermill.operators import governance, quality, rules
from pyspark.sql import functions as F

PEOPLE = [(1, 1, "ann", "bell", "(212) 555-0101"), (2, None, "bob", None, None), (3, None, "cy", "dean", "12")]


@pytest.mark.parametrize("role", [None, "", "ACCOUNTADMIN", "data_analyst_role", " data_steward"])
def test_others_see_masked(spark, role):
    found = governance.mask_customers(t.customers(spark, *PEOPLE), role)
    assert t.rows(found, "customer_id", "first_name", "last_name", "phone_number") == [
        (1, "ann", "***", "***-***-0101"), (2, "bob", "***", None), (3, "cy", "***", "***-***-12")]


@pytest.mark.parametrize("role", ["DATA_STEWARD", "data_steward", "Data_Steward"])
def test_steward_sees_all(spark, role):
    found = governance.mask_customers(t.customers(spark, *PEOPLE), role)
    assert t.rows(found, "customer_id", "last_name", "phone_number") == [
        (1, "bell", "(212) 555-0101"), (2, None, None), (3, "dean", "12")]


def test_view_follows_session_role(spark):
    t.customers(spark, *PEOPLE).createOrReplaceTempView("people")
    governance.masked_view(spark, "people", "people_masked")
    names = "SELECT last_name FROM people_masked WHERE customer_id = 1"
    assert spark.sql(names).first()[0] == "***"
    spark.sql("SET VAR reader_role = 'data_steward'")
    assert spark.sql(names).first()[0] == "bell"
    spark.sql("SET VAR reader_role = NULL")
    assert spark.sql(names).first()[0] == "***"


def test_preview(spark):
    people = t.customers(spark, *[(i, None, "a", "b", "0123456789") for i in range(30, 0, -1)])
    masked = governance.masked_preview(people, "analyst").collect()
    assert [r.customer_id for r in masked] == list(range(1, 11))
    assert all(r.masking_active and r.customer_tier == "Standard" for r in masked)
    assert not any(r.masking_active for r in governance.masked_preview(people, "data_steward").collect())


def test_pseudonyms(spark):
    rows = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n")], "id long, v string")
    key = b"0123456789abcdef"
    found = {r.v: r for r in governance.pseudonymise(rows, "id", "salt", key).collect()}
    assert found["x"].id_tokenized == found["y"].id_tokenized != found["z"].id_tokenized
    assert found["n"].id_tokenized is None
    assert found["x"].id_encrypted != found["y"].id_encrypted
    back = governance.pseudonymise(rows, "id", "salt", key).select(
        "v", F.aes_decrypt(F.unbase64("id_encrypted"), F.lit(key), F.lit("GCM")).cast("string").alias("id"))
    assert t.rows(back) == [("n", None), ("x", "1"), ("y", "1"), ("z", "2")]
    assert "id" not in governance.pseudonymise(rows, "id", "other").columns


def test_blank_is_not_null(spark):
    rows = spark.createDataFrame([("",), ("  ",), (None,), ("\t",), ("x",)], "v string")
    assert quality.blank_count(rows, "v").first()[0] == 2
    assert t.rows(quality.metric_scan(rows, "BLANK_COUNT", "v")) == [("  ",), ("",)]
    assert quality.blank_count(rows.limit(0), "v").first()[0] == 0


def test_key_tests(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k long")
    assert t.rows(quality.repeated_values(rows, "k")) == [(1, 2)]
    assert quality.missing_values(rows, "k").count() == 2
    report = quality.key_test_report({"m": rows}, "unique", [("m", "k")]).first()
    assert (report.failures, report.passed) == (1, False)
    assert quality.key_test_report({"m": rows.limit(0)}, "not_null", [("m", "k")]).first().passed


def test_relationship_check(spark):
    people = t.customers(spark, (1, 1, "a", "b", "1"), (2, 1, "a", "b", "1"), (2, 9, "a", "b", "1"), (3, None, "a", "b", "1"))
    loans = t.mortgages(spark, t.mortgage(1), t.mortgage(1), t.mortgage(2), t.mortgage(None))
    assert tuple(t.one(quality.customer_mortgage_check(people, loans)))[1:] == (3, 2, 1)
    assert tuple(t.one(quality.customer_mortgage_check(people.limit(0), loans)))[1:] == (0, 0, 0)


def test_load_summary_of_nothing(spark):
    flagged = t.transactions(spark).withColumn("is_anomaly", F.lit(True))
    assert tuple(quality.load_summary(flagged).first()) == (0, Decimal("0.00"), 0, Decimal("0"))


def test_amount_bands(spark):
    cases = [("dining", "20.00", "IN_RANGE"), ("dining", "200.00", "IN_RANGE"), ("dining", "19.99", "OUT_OF_RANGE"),
             ("dining", "200.01", "OUT_OF_RANGE"), ("dining", "25000.00", "ANOMALY_BAND"),
             ("dining", "75000.00", "ANOMALY_BAND"), ("dining", "75000.01", "OUT_OF_RANGE"),
             ("gift_purchase", "25000.00", "UNKNOWN_TYPE"), (None, "1.00", "UNKNOWN_TYPE"), ("dining", None, "OUT_OF_RANGE")]
    frame = t.transactions(spark, *[(i, 1, "2024-01-01", a, k, "HISTORICAL") for i, (k, a, _) in enumerate(cases)])
    found = {r.transaction_id: r.verdict for r in rules.amount_band_check(frame).collect()}
    assert [found[i] for i in range(len(cases))] == [v for *_, v in cases]


def test_type_mix_keeps_unseen_types(spark):
    frame = t.transactions(spark, *[(i, 1, "2024-01-01", "1.00", k, "H") for i, k in enumerate(["dining"] * 3 + ["odd"])])
    found = {r.transaction_type: r for r in rules.type_mix(frame).collect()}
    assert len(found) == 11 and found["shopping"].transaction_count == 0
    assert found["dining"].actual_percent == 75 and found["dining"].expected_percent == 7
    assert found["odd"].expected_percent is None


@pytest.mark.parametrize(
    "day, rows, fits",
    [("2024-05-01", 273, False), ("2024-05-01", 274, True), ("2024-05-01", 1096, True), ("2024-05-01", 1097, False),
     ("2024-05-04", 190, False), ("2024-05-04", 191, True), ("2024-05-05", 767, True), ("2024-05-05", 768, False)])
def test_daily_volume_edges(spark, day, rows, fits):
    frame = spark.range(rows).withColumn("transaction_date", F.lit(dt.date.fromisoformat(day)))
    assert t.one(rules.daily_volume_check(frame)).in_band is fits


def test_loan_links(spark):
    people = [(1001, 1), (5800, 4800), (5801, None), (5801, 4801), (1002, 3), (1003, None)]
    frame = t.customers(spark, *[(c, loan, "a", "b", "1") for c, loan in people])
    assert t.rows(rules.loan_link_check(frame), "customer_id", "loan_record_id") == [
        (1002, 3), (1003, None), (5801, 4801)]


def test_access_report_order(spark):
    at = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    objects = [[("t",)]]
    log = spark.createDataFrame(
        [("b", 1, at[0], *objects, *objects), ("a", 2, at[1], *objects, *objects), ("a", 3, at[2], *objects, *objects),
         ("a", 4, None, *objects, *objects)],
        "user_name string, query_id long, query_start_time timestamp, "
        "direct_objects_accessed array<struct<o:string>>, base_objects_accessed array<struct<o:string>>")
    assert [r.query_id for r in governance.access_audit(log).collect()] == [4, 3, 2, 1]
