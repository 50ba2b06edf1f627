"""The given order, part, customer and event tables in the shapes of the raw layer.

Every row of a given table becomes one row. The matching SQL is in ``plans/checks_sql.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgermill.functions import envelope as env, fixed
from ledgermill.operators import cdc
from ledgermill.plans.models import Raw
from ledgermill.session import scratch


# declared, so that no query starts by opening files to learn their columns
COLUMNS = {
    "customer": "c_custkey bigint, c_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def _scaled(column: str, factor: str, kind: str = "decimal(10,2)") -> Column:
    return (F.col(column).cast("decimal(12,2)") * F.lit(factor).cast("decimal(4,3)")).cast(kind)


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as transactions, some without an amount; every fiftieth customer's go to the next customer."""
    customer, order = F.col("o_custkey"), F.col("o_orderkey")
    placed = F.col("o_orderdate").cast("timestamp")
    priority = F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit(" "))
    return table(spark, folder, "orders").select(
        order.alias("transaction_id"),
        F.when(customer % 50 == 7, customer + 1).otherwise(customer).alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.when(order % 211 != 5, _scaled("o_totalprice", "0.020")).alias("transaction_amount"),
        F.when(order % 97 == 0, "  ").when(order % 97 == 1, "").otherwise(priority).alias("transaction_type"),
        F.when(F.col("o_orderstatus") == "P", "STREAMING").otherwise("HISTORICAL").alias("data_source"),
        placed.alias("ingestion_timestamp"),
        placed.alias("created_at"),
    )


def typed_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as transactions of the known types and two unknown ones, a few very large."""
    names = [name for name, *_ in fixed.TYPE_RULES] + ["hobby_expense", "gift_purchase"]
    kind = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("o_orderkey") % 12 + 1).cast("int"))
    anomaly = F.col("o_orderkey") % 20 == 0
    amount = F.when(anomaly, _scaled("o_totalprice", "0.150")).otherwise(_scaled("o_totalprice", "0.002"))
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        amount.alias("transaction_amount"),
        kind.alias("transaction_type"),
        anomaly.alias("is_anomaly"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers; some without a loan, some with a loan that no mortgage row has."""
    key = F.col("c_custkey")
    loan = (
        F.when((key % 25 == 0) | (key % 100 == 7), F.lit(None).cast("bigint"))
        .when(key % 40 == 3, key + 1_000_000_000)
        .otherwise(key)
    )
    digits = F.lpad((key % 10000).cast("string"), 4, "0")
    return table(spark, folder, "customer").select(
        key.alias("customer_id"),
        loan.alias("loan_record_id"),
        F.concat(F.lit(" "), F.lower("c_name"), F.lit(" ")).alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.concat(F.lit("(212) 555-"), digits).alias("phone_number"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at"),
    )


def _mortgage_columns() -> list[Column]:
    size = F.col("p_size")
    kind = (
        F.when(F.col("p_type") == "PROMO", "FSA/RHS-guaranteed")
        .when(F.col("p_type") == "SMALL", " FHA-insured ")
        .when(F.col("p_type") == "LARGE", "VA-guaranteed")
        .when(F.col("p_type") == "MEDIUM", "va-guaranteed")
        .otherwise(F.col("p_type"))
    )
    return [
        F.col("p_partkey").cast("string").alias("loan_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), ((F.col("p_partkey") % 52) * 7).cast("int")).alias("week_start_date"),
        (F.col("p_partkey") % 52).cast("int").alias("week"),
        F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("ts"),
        kind.alias("loan_type_name"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit(".re-fi")).alias("loan_purpose_name"),
        F.when(size % 10 == 0, 0).otherwise(size).cast("decimal(10,2)").alias("applicant_income_000s"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("loan_amount_000s"),
        F.concat(F.col("p_brand"), F.lit("-x_y.")).alias("county_name"),
        (F.col("p_partkey") % 2).cast("int").alias("mortgageresponse"),
    ]


def mortgages(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as mortgages, one per key."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("loan_record_id"),
        *_mortgage_columns(),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at"),
    )


def mortgage_history(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as mortgages with two versions per key and some without a key."""
    key = F.col("p_partkey")
    minutes = (key * 7919 % 1000).cast("int")
    return table(spark, folder, "part").select(
        F.when(key % 50 != 0, F.floor(key / 2)).alias("loan_record_id"),
        *_mortgage_columns(),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=minutes)).alias("created_at"),
    )


def raw(spark: SparkSession, folder: str) -> Raw:
    return Raw(
        customers=customers(spark, folder),
        mortgages=mortgages(spark, folder),
        transactions=transactions(spark, folder),
    )


def _event_fields(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return events.select(
        F.col("event_id"),
        F.col("user_id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("committed_at"),
        F.when(kind == "click", "UPDATE").when(kind == "error", "DELETE").otherwise("INSERT").alias("action"),
        F.concat(kind, F.lit("-"), (F.col("user_id") % 3).cast("string")).alias("transaction_type"),
        F.col("ts").cast("date").alias("transaction_date"),
        (F.col("value").cast("decimal(10,2)") * F.lit("37.5").cast("decimal(3,1)")).cast("decimal(10,2)").alias("transaction_amount"),
    )


def _envelope(steady: bool) -> Column:
    """One event, as ``_event_fields`` gives it, in the shape of a CDC envelope."""
    amount = F.col("transaction_amount")
    if steady:
        odd_day = F.dayofmonth("transaction_date") % 2
        amount = (F.col("user_id") * 10 + odd_day).cast("decimal(10,2)")

    def image(shown: Column) -> Column:
        whole = F.struct(
            F.concat(F.lit("enc-"), F.col("user_id").cast("string")).alias("transaction_id_encrypted"),
            F.col("user_id").alias("customer_id"),
            (F.lit("card") if steady else F.col("transaction_type")).alias("transaction_type"),
            (F.lit("2024-01-01") if steady else F.col("transaction_date").cast("string")).alias("transaction_date"),
            amount.alias("transaction_amount"),
            F.lit("STREAMING").alias("data_source"),
        )
        nothing = F.from_json(F.lit("{}"), IMAGE_TYPE)
        return F.when(shown, whole.cast(IMAGE_TYPE)).otherwise(nothing)

    action = F.col("action")
    transaction = F.struct(
        F.col("event_id").alias("transaction_id"),
        F.lit("RETAIL").alias("schema"),
        F.lit("TRANSACTIONS").alias("table"),
        action.alias("action"),
        F.concat(F.lit("K"), F.col("user_id").cast("string")).alias("primaryKey_tokenized"),
        F.concat(F.lit("u"), (F.col("user_id") % 10).cast("string")).alias("dbuser"),
        F.col("committed_at"),
        image(action != "INSERT").alias("record_before"),
        image(action != "DELETE").alias("record_after"),
    )
    return F.struct(F.lit("cdc_db_table_commit").alias("object"), transaction.alias("transaction"))


def envelope_lines(events: DataFrame) -> DataFrame:
    """Events as CDC envelopes in JSON text, column ``value``; batch or stream."""
    return _event_fields(events).select(F.to_json(_envelope(steady=False)).alias("value"))


IMAGE_TYPE = T.StructType(
    [
        T.StructField("transaction_id_encrypted", T.StringType(), True),
        T.StructField("customer_id", T.LongType(), True),
        T.StructField("transaction_type", T.StringType(), True),
        T.StructField("transaction_date", T.StringType(), True),
        T.StructField("transaction_amount", T.DecimalType(10, 2), True),
        T.StructField("data_source", T.StringType(), True),
    ]
)


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


#: events in one file of a feed, about; what a task reads does not grow with the table
FILE_ROWS = 100_000


def files_per_batch(rows: int, batches: int) -> int:
    """Files of FILE_ROWS at most that each of a number of micro-batches takes."""
    return max(1, -(-rows // (batches * FILE_ROWS)))


def events_stream(spark: SparkSession, folder: str, n_batches: int) -> DataFrame:
    """The events as a stream of files, in a fixed number of micro-batches; each is as many files as its rows need."""
    path = scratch(spark, "event-files")
    rows = events(spark, folder)
    each = files_per_batch(rows.count(), n_batches)
    rows.repartition(n_batches * each).write.parquet(path)
    return spark.readStream.schema(COLUMNS["events"]).option("maxFilesPerTrigger", each).parquet(path)


def _records(events: DataFrame, steady: bool = False) -> DataFrame:
    record = F.to_variant_object(_envelope(steady))
    # exploded, so that filters on the record do not build it a second time
    return _event_fields(events).select(F.explode(F.array(record)).alias(env.RECORD))


def cdc_landed(spark: SparkSession, folder: str, steady: bool = False) -> DataFrame:
    """Events as the landing table of CDC envelopes.

    ``steady`` amounts change only from day to day, and the before-image repeats the day's
    amount, so that most before-images continue the key's history and some do not.
    """
    return _records(events(spark, folder), steady)


def cdc_stream(spark: SparkSession, folder: str, n_files: int = 3) -> DataFrame:
    """The landing table as a live stream."""
    return _records(events_stream(spark, folder, n_files))


def channel_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The events as lines of two feed channels, each numbered from 1 without a gap: columns ``event_id`` and ``value``."""
    lines = envelope_lines(events(spark, folder))
    number = F.get_json_object("value", "$.transaction.transaction_id").cast("bigint")
    numbered = lines.select("value", number.alias("event_id"))
    first = numbered.agg(F.min("event_id")).scalar()
    place = F.col("event_id") - first
    return numbered.select(
        "event_id",
        F.concat(
            F.lit('{"channel":"c'), (place % 2).cast("string"), F.lit('","offset":'), (F.floor(place / 2) + 1).cast("string"),
            F.lit(',"record":'), F.col("value"), F.lit("}"),
        ).alias("value"),
    )


def transactions_before(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The transactions as they were before a day of changes, and the changes that lead to ``transactions``.

    A tenth of the rows is new, a tenth had another customer, day, type and amount, and rows numbered below zero are deleted;
    some of these were the largest or last of their group. The changes are structs ``old`` and ``new``.
    """
    now = transactions(spark, folder)
    tenth = F.pmod(F.col("transaction_id"), F.lit(10))
    changed = now.where(tenth == 1)
    was = changed.withColumns(
        {
            "customer_id": F.col("customer_id") + F.col("transaction_id") % 3,
            "transaction_date": F.date_sub("transaction_date", (F.col("transaction_id") % 70).cast("int")),
            "transaction_amount": (F.col("transaction_amount") * F.lit("1.50").cast("decimal(3,2)")).cast("decimal(10,2)"),
            "transaction_type": F.when(F.col("transaction_id") % 4 == 1, "older").otherwise(F.col("transaction_type")),
        }
    )
    gone = now.where(tenth == 2).withColumns(
        {
            "transaction_id": -F.col("transaction_id"),
            "transaction_amount": F.when(F.col("transaction_id") % 3 == 1, F.col("transaction_amount") + 40_000).otherwise(F.col("transaction_amount")).cast("decimal(10,2)"),
            "transaction_date": F.last_day("transaction_date"),
        }
    )
    before = now.where((tenth != 0) & (tenth != 1)).unionByName(was).unionByName(gone)
    image = lambda rows, name: rows.select("transaction_id", F.struct(*rows.columns).alias(name))
    nothing = F.lit(None).cast(now.schema)
    changes = image(was, "old").join(image(changed, "new"), "transaction_id").select("old", "new")
    changes = changes.unionByName(image(now.where(tenth == 0), "new").select(nothing.alias("old"), "new"))
    return before, changes.unionByName(image(gone, "old").select("old", nothing.alias("new")))


def feed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Envelope lines of which some are cut short, so that they are no JSON, and some have no usable commit time."""
    lines = envelope_lines(events(spark, folder))
    event_id = F.get_json_object("value", "$.transaction.transaction_id").cast("bigint")
    committed_at = lambda text: F.regexp_replace("value", '"committed_at":[0-9]+', text)
    return lines.select(
        F.when(event_id % 500 == 3, F.substring("value", 1, 40))
        .when(event_id % 500 == 7, committed_at('"committed_at":9000000000000000000'))
        .when(event_id % 500 == 11, committed_at('"committed_at":-9000000000000000000'))
        .when(event_id % 500 == 13, committed_at('"committed_at":"soon"'))
        .when(event_id % 500 == 17, committed_at('"other":1'))
        .otherwise(F.col("value"))
        .alias("value")
    )


def ingested(spark: SparkSession, folder: str) -> DataFrame:
    """Insert events as streamed rows of many days; orders as rows of one load, or of none.

    Orders from the stream have no ingest time, which a deletion by day must not touch.
    """
    loaded = F.when(F.col("data_source") == "HISTORICAL", F.lit("2024-01-10 00:00:00")).cast("timestamp")
    orders = transactions(spark, folder).withColumns({"ingestion_timestamp": loaded, "created_at": loaded})
    return cdc.cdc_as_transactions(cdc_landed(spark, folder)).unionByName(orders)


def access_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as an access log with one object per query."""
    objects = F.array(F.struct(F.col("event_type").alias("object_name")))
    return events(spark, folder).select(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("user_name"),
        F.col("event_id").alias("query_id"),
        F.col("ts").cast("timestamp").alias("query_start_time"),
        objects.alias("direct_objects_accessed"),
        objects.alias("base_objects_accessed"),
    )
