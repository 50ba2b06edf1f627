"""The physical plans have the shape that holds at scale."""

import contextlib
import datetime as dt
import io

import frames as t
import pytest
from ledgermill.operators import cdc, dashboard, marts, mortgages, quality, staging
from ledgermill.plans import models
from ledgermill.session import scratch
from ledgermill.sources import stores


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def stored(spark):
    """Raw tables as files, so that scans show what is pushed into them."""
    frames = {
        "customers": t.customers(spark, (1, 1, "a", "b", "1")),
        "mortgages": t.mortgages(spark, t.mortgage(1)),
        "transactions": t.transactions(spark, (1, 1, "2024-05-01", "1.00", "x", "STREAMING")),
        "landed": t.landed(spark, t.envelope(1, "INSERT", after=t.image("1.00"))),
    }
    read = {}
    for name, frame in frames.items():
        path = scratch(spark, name)
        frame.write.parquet(path)
        read[name] = spark.read.parquet(path)
    return read


@pytest.fixture(scope="module")
def stg(stored):
    return models.staging_models(models.Raw(stored["customers"], stored["mortgages"], stored["transactions"]))


def test_no_nested_loops_and_no_python(spark, stored, stg):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        profile = models.customer_360(stg)
        plans = [
            plan(df) for df in (
                profile,
                marts.customer_segments(profile),
                dashboard.dashboard_summary(profile, stg["stg_transactions"], dt.date(2024, 5, 31)),
                quality.customer_mortgage_check(stored["customers"], stored["mortgages"]),
                cdc.cdc_current_state(stored["landed"]),
                cdc.cdc_continuity(stored["landed"]),
            )
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for text in plans:
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
            assert bad not in text


def test_spend_is_summed_before_the_shuffle(stg):
    text = plan(marts.spend_per_customer(stg["stg_transactions"]))
    assert "partial_sum(transaction_amount" in text
    assert "ReadSchema: struct<transaction_id:bigint,customer_id:bigint,transaction_date:date,transaction_amount:decimal(10,2)>" in text


def test_latest_row_is_picked_before_the_shuffle(stored):
    text = plan(mortgages.mortgage_base(stored["mortgages"]))
    assert text.count("WindowGroupLimit") >= 2  # one before, one after the exchange
    assert "PushedFilters: [IsNotNull(loan_record_id)]" in text


def test_dashboard_reads_recent_days_only(stg):
    shown = dashboard.dashboard_transactions(stg["stg_transactions"], dt.date(2024, 5, 31), 30)
    text = plan(shown)
    assert "GreaterThanOrEqual(transaction_date,2024-05-01)" in text
    assert "TakeOrderedAndProject" in text
    summary = plan(dashboard.dashboard_summary(models.customer_360(stg), stg["stg_transactions"], dt.date(2024, 5, 31)))
    assert "GreaterThanOrEqual(transaction_date,2024-05-01)" in summary


def test_cdc_scan_reads_only_named_paths(stored):
    text = plan(cdc.cdc_action_summary(stored["landed"]))
    assert "ReadSchema: struct<record_content:struct<0:string,1:bigint,2:decimal(38,0)>>" in text


def test_store_prunes_partitions(spark):
    rows = t.transactions(spark, (1, 1, "2024-05-01", "1.00", "x", "STREAMING"), (2, 1, "2024-05-01", "1.00", "x", "HISTORICAL"))
    stores.create_transaction_store(rows, "pruned_store")
    text = plan(spark.table("pruned_store").where("data_source = 'STREAMING'"))
    assert "PartitionFilters: [isnotnull(data_source" in text


def test_staging_needs_no_shuffle(stg):
    for frame in stg.values():
        assert "Exchange" not in plan(frame)


def test_staging_keeps_types(stg):
    types = dict(stg["stg_transactions"].dtypes)
    assert types["transaction_amount"] == "decimal(10,2)" and types["transaction_month"] == "date"
    assert dict(staging.stg_transactions(stg["stg_transactions"]).dtypes)["transaction_month"] == "date"


def test_customers_sharing_one_loan_are_split_over_tasks(spark):
    """A third of the customers has one loan: the join's hot partition is read in pieces."""
    from pyspark.sql import functions as F

    ids = F.col("id")
    people = spark.range(60_000).select(
        ids.alias("customer_id"), F.when(ids % 3 == 0, 7).otherwise(ids).cast("bigint").alias("loan_record_id"),
        F.sha2(ids.cast("string"), 256).alias("first_name"), F.lit("l").alias("last_name"),
        F.lit("1").alias("phone_number"), F.lit(t.NOW).alias("created_at"))
    path = scratch(spark, "hot")
    people.write.parquet(path)
    loans = t.mortgages(spark, t.mortgage(7), t.mortgage(8))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.files.maxPartitionBytes": "256k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        stg = staging.stg_customers(spark.read.parquet(path))
        profiles = marts.customer_profiles(stg, staging.stg_mortgages(loans))
        counted = profiles.groupBy("loan_amount").count()
        # the third, and the customers numbered 7 and 8
        assert sorted(r["count"] for r in counted.collect()) == [20_002, 39_998]
        assert "SortMergeJoin(skew=true)" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_day_with_most_rows_is_written_by_several_tasks(spark):
    from pyspark.sql import functions as F

    rows = spark.range(200_000).select(
        F.col("id").alias("transaction_id"), F.col("id").alias("customer_id"),
        F.lit(dt.date(2024, 5, 1)).alias("transaction_date"), F.lit(1).cast("decimal(10,2)").alias("transaction_amount"),
        F.sha2(F.col("id").cast("string"), 256).alias("transaction_type"), F.lit("HISTORICAL").alias("data_source"),
        F.lit(t.NOW).alias("ingestion_timestamp"), F.lit(t.NOW).alias("created_at"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        stores.create_transaction_store(rows, "one_day_store")
    finally:
        spark.conf.set(key, before)
    assert spark.table("one_day_store").select(F.input_file_name()).distinct().count() > 1


def test_views_answer_sql(spark, stored):
    raw = models.Raw(stored["customers"], stored["mortgages"], stored["transactions"])
    models.register_views(spark, raw, stored["landed"], role="data_steward")
    queries = [
        "SELECT count(*) FROM customer_table JOIN mortgage_table USING (loan_record_id)",
        "SELECT count(*) FROM transactions_table WHERE data_source = 'STREAMING'",
        "SELECT count(*) FROM (SELECT * FROM cdc_transactions ORDER BY transaction_id DESC LIMIT 10)",
        "SELECT count(*) FROM customer_360 c LEFT JOIN stg_transactions t ON c.customer_id = t.customer_id",
        "SELECT count(*) FROM cdc_streaming_table",
        "SELECT count(*) FROM mortgage_base",
        "SELECT count(*) FROM transaction_summary",
    ]
    assert [spark.sql(q).first()[0] for q in queries] == [1] * len(queries)
    assert spark.sql("SELECT last_name FROM customer_table").first()[0] == "***"
    assert spark.sql("SELECT last_name FROM customer_360").first()[0] == "B"


def test_recent_activity_reads_recent_days(spark):
    from ledgermill.sources import files

    day = 86_400_000
    events = t.landed(spark, *[t.envelope(i, "INSERT", at=1_700_000_000_000 + i * day, after=t.image("1.00"))
                               for i in range(5)], t.envelope(9, "INSERT", at=None))
    path = scratch(spark, "by-day")
    files.with_commit_date(events).write.partitionBy(files.COMMIT_DATE).parquet(path)
    dated = spark.read.parquet(path)
    as_of = dt.datetime(2023, 11, 18, 23, 0)  # the last event is at 22:13:20 that day
    found = cdc.cdc_recent_activity(dated, as_of)
    assert found.collect() == cdc.cdc_recent_activity(events, as_of).collect()
    assert found.first().recent_transactions == 1
    text = plan(found)
    assert "PartitionFilters: [isnotnull(commit_date" in text and "commit_date" in text
    assert cdc.cdc_total(dated).first()[0] == 6
    assert cdc.cdc_parsed(dated).count() == 6
