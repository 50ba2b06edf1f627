"""Every query by name, over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgermill.functions import distinct, envelope as env
from ledgermill.operators import cdc, dashboard, governance, marts, mortgages, quality, rules, staging
from ledgermill.plans import models, refresh, sql_functions
from ledgermill.plans.report import plain
from ledgermill.session import name_folder, pin_utc, scratch
from ledgermill.sources import files, given, loads, stores
from ledgermill.streaming import changes, channel, keyed, payments, sinks

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2001, 8, 1)
CDC_AS_OF = dt.datetime(2024, 1, 30, 23, 0)
WHOLE_PERIOD = 2500  # days that cover all given orders
SHOWN_TYPES = ["5-low", "1-urgent", "3-medium"]
DELETED_DAY = dt.date(2024, 1, 10)
SALT = "check-salt"

#: where the checks keep intermediate tables if the session names no shared folder
CHECK_FOLDER = "/tmp/ledgermill-checks"

REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register a query under its own name, in UTC and with plain output columns."""

    def checked(spark: SparkSession, folder: str) -> DataFrame:
        pin_utc(spark)
        if spark.sparkContext.master.startswith("local["):
            name_folder(spark, CHECK_FOLDER)
        return plain(run(spark, folder))

    REGISTRY[run.__name__] = checked
    return run


# ingest and stores: written to a fresh path in the shared folder and read back


@query
def load_mortgages_csv(spark, folder):
    path = scratch(spark, "mortgages-csv")
    columns = [f.name for f in files.schemas.MORTGAGE_FILE.fields]
    given.mortgages(spark, folder).select(*columns).write.option("header", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return files.load_mortgages_csv(spark, path).drop("created_at")


@query
def number_mortgages(spark, folder):
    return mortgages.number_mortgages(given.mortgages(spark, folder)).drop("created_at")


@query
def write_jsonl(spark, folder):
    path = scratch(spark, "transactions-json")
    stores.write_jsonl(given.typed_transactions(spark, folder), path)
    return files.load_transactions_json(spark, path).drop("ingestion_timestamp", "created_at")


@query
def load_transactions_json(spark, folder):
    path = scratch(spark, "transactions-json")
    given.transactions(spark, folder).drop("ingestion_timestamp", "created_at").write.json(path)
    return files.load_transactions_json(spark, path).drop("ingestion_timestamp", "created_at")


@query
def load_customers_json(spark, folder):
    path = scratch(spark, "customers-json")
    stores.write_customers_jsonl(given.customers(spark, folder).drop("created_at"), path)
    return files.load_customers_json(spark, path).drop("created_at")


@query
def write_lakehouse_copy(spark, folder):
    path = scratch(spark, "customers-copy")
    stores.write_lakehouse_copy(given.customers(spark, folder), path)
    return spark.read.parquet(path)


@query
def land_cdc(spark, folder):
    path = scratch(spark, "cdc-text")
    given.feed_lines(spark, folder).write.text(path)
    lines = spark.read.text(path)
    kept = files.landed(lines).agg(
        F.lit("landed").alias("outcome"),
        F.count("*").alias("records"),
        F.sum(env.Envelope().event_id()).alias("id_sum"),
    )
    refused = files.rejected(lines).agg(
        F.lit("rejected").alias("outcome"),
        F.count("*").alias("records"),
        F.lit(None).cast("bigint").alias("id_sum"),
    )
    return kept.unionByName(refused)


CHECK_SCHEMA = "LEDGERMILL_CHECK"


def _check_schema(spark):
    where = scratch(spark, "warehouse")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {CHECK_SCHEMA} LOCATION '{where}'")


@query
def publish_models(spark, folder):
    _check_schema(spark)
    published = models.publish(spark, given.raw(spark, folder), mart_schema=" ledgermill_check ")
    counts = quality.raw_counts({name: spark.table(at) for name, at in published.items()})
    return counts.select(F.col("table_name").alias("model"), F.col("record_count").alias("records"))


def _published(spark, folder, model):
    _check_schema(spark)
    return spark.table(models.publish(spark, given.raw(spark, folder), mart_schema=" ledgermill_check ")[model])


@query
def published_customer_360(spark, folder):
    return _published(spark, folder, "customer_360")


@query
def published_transaction_summary(spark, folder):
    return _published(spark, folder, "transaction_summary")


@query
def delete_streaming_rows(spark, folder):
    _check_schema(spark)
    table = f"{CHECK_SCHEMA}.store_" + scratch(spark, "store").rsplit("-", 1)[-1]
    stores.create_transaction_store(given.ingested(spark, folder), table)
    gone = stores.delete_streaming_rows(spark, table, DELETED_DAY)
    return (
        spark.table(table)
        .groupBy("data_source")
        .agg(
            F.count("*").alias("records_left"),
            F.sum("transaction_amount").alias("amount_left"),
        )
        .withColumn("records_deleted", F.lit(gone).cast("bigint"))
    )


@query
def without_streaming_day(spark, folder):
    left = stores.without_streaming_day(given.ingested(spark, folder), DELETED_DAY)
    return left.select("transaction_id", "data_source", "transaction_amount", "ingestion_timestamp")


# staging and marts


def _staging(spark, folder):
    return models.staging_models(given.raw(spark, folder))


def _stg_customers(spark, folder, role=None):
    return staging.stg_customers(governance.mask_customers(given.customers(spark, folder), role))


def _stg_transactions(spark, folder):
    return staging.stg_transactions(given.transactions(spark, folder))


@query
def stg_customers(spark, folder):
    return _stg_customers(spark, folder).drop("created_at")


@query
def stg_customers_steward(spark, folder):
    return _stg_customers(spark, folder, "data_steward").drop("created_at")


@query
def stg_transactions(spark, folder):
    return _stg_transactions(spark, folder)


@query
def stg_mortgages(spark, folder):
    return staging.stg_mortgages(given.mortgages(spark, folder)).drop("created_at")


@query
def mortgage_base(spark, folder):
    return mortgages.mortgage_base(given.mortgage_history(spark, folder))


@query
def mortgage_dedup(spark, folder):
    latest = mortgages.latest_mortgages(given.mortgage_history(spark, folder))
    return latest.select("loan_record_id", "loan_id", "created_at")


@query
def customer_360(spark, folder):
    return models.customer_360(_staging(spark, folder))


@query
def customer_segments(spark, folder):
    return marts.customer_segments(models.customer_360(_staging(spark, folder)))


@query
def transaction_summary(spark, folder):
    return marts.transaction_summary(_stg_transactions(spark, folder))


# dashboard


def _chosen(spark, folder):
    return dashboard.chosen_transactions(_stg_transactions(spark, folder), AS_OF, WHOLE_PERIOD, SHOWN_TYPES)


@query
def dashboard_transactions(spark, folder):
    return dashboard.dashboard_transactions(_stg_transactions(spark, folder), AS_OF, 365, SHOWN_TYPES)


@query
def volume_by_type(spark, folder):
    return dashboard.volume_by_type(_chosen(spark, folder))


@query
def daily_trends(spark, folder):
    return dashboard.daily_trends(_chosen(spark, folder))


@query
def recent_transactions(spark, folder):
    return dashboard.recent_transactions(_chosen(spark, folder))


@query
def dashboard_summary(spark, folder):
    """Over the published mart, as a dashboard reads it."""
    stg = _staging(spark, folder)
    path = scratch(spark, "customer-360")
    models.customer_360(stg).write.parquet(path)
    return dashboard.dashboard_summary(spark.read.parquet(path), stg["stg_transactions"], AS_OF)


@query
def masked_preview(spark, folder):
    return governance.masked_preview(given.customers(spark, folder), "DATA_ANALYST_ROLE")


# CDC


@query
def cdc_parsed(spark, folder):
    parsed = cdc.cdc_parsed(given.cdc_landed(spark, folder))
    return parsed.withColumn("raw_json", F.variant_get("raw_json", "$.transaction.dbuser", "string"))


@query
def cdc_transactions(spark, folder):
    return cdc.cdc_transactions(given.cdc_landed(spark, folder))


@query
def cdc_as_transactions(spark, folder):
    return cdc.cdc_as_transactions(given.cdc_landed(spark, folder))


@query
def cdc_action_summary(spark, folder):
    return cdc.cdc_action_summary(given.cdc_landed(spark, folder))


@query
def cdc_transaction_types(spark, folder):
    return cdc.cdc_transaction_types(given.cdc_landed(spark, folder))


@query
def cdc_top_types(spark, folder):
    return cdc.cdc_top_types(given.cdc_landed(spark, folder))


@query
def cdc_total(spark, folder):
    return cdc.cdc_total(given.cdc_landed(spark, folder))


@query
def cdc_latest_rows(spark, folder):
    return cdc.cdc_latest_rows(given.cdc_landed(spark, folder))


@query
def cdc_latest_inserts(spark, folder):
    return cdc.cdc_latest_inserts(given.cdc_landed(spark, folder))


@query
def cdc_recent_activity(spark, folder):
    return cdc.cdc_recent_activity(given.cdc_landed(spark, folder), CDC_AS_OF)


def _stored(spark, folder):
    """The landing table as it is kept: shredded files by commit day."""
    path = scratch(spark, "landing")
    landed = files.with_commit_date(given.cdc_landed(spark, folder))
    landed.write.partitionBy(files.COMMIT_DATE).parquet(path)
    return spark.read.parquet(path)


@query
def stored_cdc_recent_activity(spark, folder):
    return cdc.cdc_recent_activity(_stored(spark, folder), CDC_AS_OF)


@query
def stored_cdc_action_summary(spark, folder):
    return cdc.cdc_action_summary(_stored(spark, folder).drop(files.COMMIT_DATE))


@query
def high_value_cdc(spark, folder):
    return cdc.high_value_cdc(given.cdc_landed(spark, folder))


@query
def method_comparison(spark, folder):
    return cdc.method_comparison(given.cdc_landed(spark, folder), given.transactions(spark, folder))


@query
def cdc_current_state(spark, folder):
    return cdc.cdc_current_state(given.cdc_landed(spark, folder))


@query
def cdc_continuity(spark, folder):
    return cdc.cdc_continuity(given.cdc_landed(spark, folder, steady=True))


# governance and quality


@query
def mask_customers(spark, folder):
    return governance.mask_customers(given.customers(spark, folder), "ACCOUNTADMIN").drop("created_at")


@query
def mask_customers_steward(spark, folder):
    return governance.mask_customers(given.customers(spark, folder), "Data_Steward").drop("created_at")


@query
def masked_view(spark, folder):
    given.customers(spark, folder).createOrReplaceTempView("customers_to_mask")
    governance.masked_view(spark, "customers_to_mask", "customers_masked")
    spark.sql("SET VAR reader_role = 'data_analyst_role'")
    return spark.table("customers_masked").drop("created_at")


@query
def pseudonymise_keys(spark, folder):
    rows = given.transactions(spark, folder).select("transaction_id", "customer_id", "transaction_amount")
    return governance.pseudonymise(rows, "transaction_id", SALT)


@query
def access_audit(spark, folder):
    return governance.access_audit(given.access_log(spark, folder))


@query
def blank_count(spark, folder):
    return quality.blank_count(given.transactions(spark, folder), "transaction_type")


@query
def blank_rows(spark, folder):
    return quality.metric_scan(given.transactions(spark, folder), "core.blank_count", "transaction_type")


def _key_tests(spark, folder, test, also):
    stg = _staging(spark, folder)
    tested = {**stg, "customer_360": models.customer_360(stg)}
    return quality.key_test_report(tested, test, quality.TESTED_KEYS + [also])


@query
def dq_unique(spark, folder):
    return _key_tests(spark, folder, "unique", ("stg_transactions", "customer_id"))


@query
def dq_unique_values(spark, folder):
    return quality.repeated_values(_stg_transactions(spark, folder), "customer_id")


@query
def dq_not_null(spark, folder):
    return _key_tests(spark, folder, "not_null", ("stg_customers", "loan_record_id"))


@query
def raw_counts(spark, folder):
    raw = given.raw(spark, folder)
    path = scratch(spark, "customers-copy")
    stores.write_lakehouse_copy(raw.customers, path)
    return quality.raw_counts(
        {
            "MORTGAGE_TABLE": raw.mortgages,
            "CUSTOMER_TABLE": raw.customers,
            "TRANSACTIONS_TABLE": raw.transactions,
            "CUSTOMER_TABLE_ICEBERG": spark.read.parquet(path),
        }
    )


@query
def customer_mortgage_check(spark, folder):
    raw = given.raw(spark, folder)
    return quality.customer_mortgage_check(raw.customers, raw.mortgages)


@query
def source_profile(spark, folder):
    return quality.source_profile(given.transactions(spark, folder))


@query
def load_summary(spark, folder):
    return quality.load_summary(given.typed_transactions(spark, folder))


@query
def customer_file_profile(spark, folder):
    return quality.customer_file_profile(given.customers(spark, folder))


# feed rules


@query
def amount_band_check(spark, folder):
    return rules.amount_band_check(given.typed_transactions(spark, folder))


@query
def type_mix(spark, folder):
    return rules.type_mix(given.typed_transactions(spark, folder))


@query
def daily_volume_check(spark, folder):
    return rules.daily_volume_check(given.transactions(spark, folder), target=7)


@query
def loan_link_check(spark, folder):
    return rules.loan_link_check(given.customers(spark, folder), offset=0, last_with_loan=1000)


# live queries: everything there is, in micro-batches, then read back


def _payment_feed(spark, folder):
    """The transactions as feed files, some lines cut short; read one file at a time."""
    path = scratch(spark, "payment-feed")
    rows = given.typed_transactions(spark, folder)
    line = F.to_json(F.struct(*rows.columns))
    cut = F.when(F.col("transaction_id") % 300 == 5, F.substring(line, 1, 25)).otherwise(line)
    rows.select(cut.alias("value")).repartition(3).write.text(path)
    return payments.feed(spark, path, files_per_batch=1)


@query
def stream_transactions(spark, folder):
    out = scratch(spark, "stream-store")
    payments.append_transactions(_payment_feed(spark, folder), f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/table").drop("ingestion_timestamp", "created_at", "ingest_date")


@query
def stream_cdc_land(spark, folder):
    out = scratch(spark, "stream-land")
    given.feed_lines(spark, folder).repartition(3).write.text(f"{out}/feed")
    lines = payments.feed(spark, f"{out}/feed", files_per_batch=2)
    for live in changes.land(lines, f"{out}/landed", f"{out}/rejects", f"{out}/checkpoint"):
        live.awaitTermination()
    kept = spark.read.parquet(f"{out}/landed").agg(
        F.lit("landed").alias("outcome"),
        F.count("*").alias("records"),
        F.sum(env.Envelope().event_id()).alias("id_sum"),
    )
    refused = spark.read.parquet(f"{out}/rejects").agg(
        F.lit("rejected").alias("outcome"),
        F.count("*").alias("records"),
        F.lit(None).cast("bigint").alias("id_sum"),
    )
    return kept.unionByName(refused)


@query
def stream_counters(spark, folder):
    out = scratch(spark, "stream-counters")
    payments.keep_counters(_payment_feed(spark, folder), f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return payments.latest_counters(spark, f"{out}/table")


@query
def stream_action_summary(spark, folder):
    out = scratch(spark, "stream-sums")
    changes.keep_partial_sums(given.cdc_stream(spark, folder), f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return changes.action_summary(spark, f"{out}/table")


@query
def stream_type_summary(spark, folder):
    out = scratch(spark, "stream-sums")
    changes.keep_partial_sums(given.cdc_stream(spark, folder), f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return changes.type_summary(spark, f"{out}/table")


@query
def stream_recent_activity(spark, folder):
    out = scratch(spark, "stream-recent")
    # one file: its windows leave out rows that come late, which unordered files would all have
    live = changes.recent_activity(given.cdc_stream(spark, folder, 1))
    sinks.append(live, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/table")


@query
def stream_last_hour(spark, folder):
    out = scratch(spark, "stream-moments")
    changes.keep_moments(given.cdc_stream(spark, folder), f"{out}/table", f"{out}/checkpoint").awaitTermination()
    changes.compact_moments(spark, f"{out}/table")
    return changes.last_hours(spark, f"{out}/table", CDC_AS_OF)


@query
def stream_delete_day(spark, folder):
    """Half of the feed is stored and deleted, the rest arrives afterwards."""
    out = scratch(spark, "stream-delete")
    rows = given.typed_transactions(spark, folder)
    line = F.to_json(F.struct(*rows.columns)).alias("value")
    for part in (0, 1):
        rows.where(F.col("transaction_id") % 2 == part).select(line).write.mode("append").text(f"{out}/feed")
        payments.append_transactions(payments.feed(spark, f"{out}/feed"), f"{out}/table", f"{out}/checkpoint").awaitTermination()
        if part == 0:
            payments.open_store(spark, f"{out}/table")
            days = [r[0] for r in spark.read.parquet(f"{out}/table").select("ingest_date").distinct().collect()]
            gone = sum(payments.delete_day(spark, f"{out}/table", day) for day in days)
    left = payments.read_store(spark, f"{out}/table")
    return left.agg(F.count("*").alias("records_left"), F.sum("transaction_id").alias("id_sum")).withColumn(
        "records_deleted", F.lit(gone).cast("bigint")
    )


@query
def stream_high_value(spark, folder):
    out = scratch(spark, "stream-high")
    live = changes.high_value(given.cdc_stream(spark, folder))
    sinks.append(live, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/table")


@query
def stream_current_state(spark, folder):
    out = scratch(spark, "stream-state")
    changes.keep_versions(given.cdc_stream(spark, folder), f"{out}/table", f"{out}/checkpoint").awaitTermination()
    changes.compact_versions(spark, f"{out}/table")
    return changes.current_state(spark, f"{out}/table")


# a table of current rows by key


def _keyed(spark, folder):
    """Three micro-batches, merged as soon as there are two of a level."""
    out = scratch(spark, "keyed")
    keyed.create(spark, f"{out}/table", 16)
    keyed.keep_rows(given.cdc_stream(spark, folder), f"{out}/table", f"{out}/checkpoint").awaitTermination()
    keyed.merge(spark, f"{out}/table", fan=2)
    return f"{out}/table"


@query
def keyed_current_state(spark, folder):
    return keyed.rows(spark, _keyed(spark, folder))


LOOKED_UP = ["K1", "K2", "K3", "K5", "K8", "K13", "K21", "K999999999"]


@query
def keyed_lookup(spark, folder):
    return keyed.rows(spark, _keyed(spark, folder), LOOKED_UP)


@query
def channel_offsets(spark, folder):
    """A producer that sends half, then its last 100 rows and the other half, then everything once more."""
    out = scratch(spark, "channel")
    lines = given.channel_lines(spark, folder)
    middle, n = lines.agg(F.percentile_approx("event_id", 0.5), F.count("*")).first()
    each = given.files_per_batch(n, 2)
    sent = [
        lines.where(F.col("event_id") < middle),
        lines.where(F.col("event_id") >= middle - 100),
        lines,
    ]
    channel.create(spark, f"{out}/table")
    for part in sent:
        part.select("value").repartition(2 * each).write.mode("append").text(f"{out}/feed")
        feed = payments.feed(spark, f"{out}/feed", files_per_batch=each)
        channel.keep_channel(feed, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    stored = channel.landed(spark, f"{out}/table")
    records = stored.groupBy("channel").agg(F.count("*").alias("records"), F.sum(env.Envelope().event_id()).alias("id_sum"))
    return channel.committed_offsets(spark, f"{out}/table").join(records, "channel")


# exact distinct counts from bitmaps


@query
def source_customers(spark, folder):
    return distinct.count_per(given.transactions(spark, folder), ["data_source"], "customer_id", "unique_customers")


# marts that follow changes


def _refreshed(spark, folder):
    path = scratch(spark, "refresh")
    raw = given.raw(spark, folder)
    stg = models.staging_models(raw)
    before, changes_ = given.transactions_before(spark, folder)
    refresh.build({**stg, "stg_transactions": staging.stg_transactions(before)}, path, 16)
    images = {}
    for side in ("old", "new"):
        rows = staging.stg_transactions(changes_.where(F.col(side).isNotNull()).select(f"{side}.*"))
        images[side] = rows.select(F.struct(*rows.columns).alias(side))
    signed = images["old"].withColumn("new", F.lit(None).cast(images["new"].schema["new"].dataType))
    signed = signed.unionByName(images["new"], allowMissingColumns=True)
    refresh.refresh(signed, stg["stg_transactions"], path, 16)
    return path


@query
def refreshed_transaction_summary(spark, folder):
    return refresh.stored_summary(spark, _refreshed(spark, folder))


@query
def refreshed_customer_360(spark, folder):
    return refresh.stored_customer_360(spark, _refreshed(spark, folder), buckets=16)


@query
def load_once(spark, folder):
    """A folder that grows, loaded three times."""
    out = scratch(spark, "loads")
    rows = given.transactions(spark, folder).drop("ingestion_timestamp", "created_at")
    for part in (0, 1):
        rows.where(F.col("transaction_id") % 2 == part).repartition(3).write.mode("append").json(f"{out}/folder")
        loads.load_new(spark, f"{out}/folder", f"{out}/table", files.load_transactions_json)
    loads.load_new(spark, f"{out}/folder", f"{out}/table", files.load_transactions_json)
    return loads.loaded_rows(spark, f"{out}/table").drop("ingestion_timestamp", "created_at")


@query
def sql_metric_scan(spark, folder):
    given.transactions(spark, folder).createOrReplaceTempView("transactions_to_scan")
    scan = sql_functions.metric_scan_function(spark, "transactions_to_scan")
    return spark.sql(f"SELECT * FROM {scan}('core.BLANK_COUNT', 'transaction_type')")


@query
def policy_views(spark, folder):
    given.customers(spark, folder).createOrReplaceTempView("customers_behind_policies")
    sql_functions.create_role_variable(spark)
    sql_functions.create_policies(spark)
    sql_functions.masked_views(
        spark,
        {"customers_by_policy": "customers_behind_policies"},
        [("customers_by_policy", column, policy) for _, column, policy in sql_functions.ATTACHED],
    )
    spark.sql("SET VAR reader_role = 'data_analyst_role'")
    return spark.table("customers_by_policy").drop("created_at")


@query
def stream_counted(spark, folder):
    out = scratch(spark, "counted")
    payments.append_counted(_payment_feed(spark, folder), f"{out}/table", f"{out}/counts", f"{out}/checkpoint").awaitTermination()
    return payments.counted(spark, f"{out}/counts")
