import datetime as dt
from decimal import Decimal

import frames as t
import pytest
from ledgermill.operators import cdc
from ledgermill.plans import models
from ledgermill.session import scratch
from ledgermill.sources import files, stores

CSV = """WEEK_START,W,ID,TS,TYPE,PURPOSE,INCOME,AMOUNT,COUNTY,RESP
2024-01-01,1,361354,a,FHA-insured,Home purchase,55.5,200,Kings County,1
2024-01-08,2,361355,,VA-guaranteed,Refinancing,,100.25,Queens,0
"""


def test_csv_by_position(spark, tmp_path):
    (tmp_path / "m.csv").write_text(CSV)
    found = files.load_mortgages_csv(spark, str(tmp_path)).orderBy("week").collect()
    assert found[0].loan_id == "361354" and found[0].applicant_income_000s == Decimal("55.50")
    assert found[1].ts is None and found[1].applicant_income_000s is None
    assert found[0].created_at is not None


@pytest.mark.parametrize("line", ["2024-13-01,1,1,a,b,c,1,1,d,1", "2024-01-01,x,1,a,b,c,1,1,d,1", "2024-01-01,1"])
def test_csv_bad_row_stops_the_load(spark, tmp_path, line):
    (tmp_path / "m.csv").write_text(CSV + line + "\n")
    with pytest.raises(Exception):
        files.load_mortgages_csv(spark, str(tmp_path)).collect()


def test_transactions_json(spark, tmp_path):
    (tmp_path / "t.json").write_text(
        '{"transaction_id": 1, "customer_id": "7", "transaction_date": "2024-05-01", "transaction_amount": 12.5,'
        ' "transaction_type": "dining", "data_source": "HISTORICAL"}\n'
        '{"transaction_id": 2, "customer_id": 8, "transaction_date": "2024-05-02", "transaction_amount": "1.005",'
        ' "transaction_type": "dining"}\n')
    found = files.load_transactions_json(spark, str(tmp_path)).orderBy("transaction_id").collect()
    assert tuple(found[0])[:6] == (1, 7, dt.date(2024, 5, 1), Decimal("12.50"), "dining", "HISTORICAL")
    assert (found[1].transaction_amount, found[1].data_source) == (Decimal("1.01"), None)
    assert found[0].ingestion_timestamp == found[0].created_at is not None


@pytest.mark.parametrize("line", ["{broken", '{"transaction_id": "x"}', '{"transaction_date": "May"}'])
def test_json_bad_row_stops_the_load(spark, tmp_path, line):
    (tmp_path / "t.json").write_text(line + "\n")
    with pytest.raises(Exception):
        files.load_transactions_json(spark, str(tmp_path)).collect()


def test_absent_loan_id(spark, tmp_path):
    path = str(tmp_path / "c")
    people = t.customers(spark, (1001, 1, "a", "b", "(1) 2-3"), (5801, None, "c", "d", "(1) 2-4"))
    stores.write_customers_jsonl(people.drop("created_at").coalesce(1), path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert sum("loan_record_id" in line for line in lines) == 1
    assert t.rows(files.load_customers_json(spark, path), "customer_id", "loan_record_id") == [(1001, 1), (5801, None)]


def test_jsonl_leaves_out_the_flag(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "j")
    rows = t.transactions(spark, (1, 1, "2024-05-01", "1.50", "x", "STREAMING")).withColumn("is_anomaly", F.lit(True))
    stores.write_jsonl(rows, path)
    line = spark.read.text(path).first().value
    assert "is_anomaly" not in line and '"data_source":"HISTORICAL"' in line and '"transaction_amount":1.50' in line


def test_cdc_lines(spark, tmp_path):
    (tmp_path / "e.json").write_text("\n".join([t.envelope(1, "INSERT", after=t.image("1.00")), "{cut", "", "[1]"]))
    lines = spark.read.text(str(tmp_path))
    assert files.landed(lines).count() == 2
    assert t.rows(files.rejected(lines)) == [("",), ("{cut",)]
    stored = scratch(spark, "landed")
    files.load_cdc(spark, str(tmp_path)).write.parquet(stored)
    assert t.rows(cdc.cdc_transactions(spark.read.parquet(stored)), "transaction_id") == [(1,)]


def test_delete_one_streamed_day(spark):
    day, other = dt.datetime(2024, 5, 1, 23, 59), dt.datetime(2024, 5, 2)
    rows = t.transactions(
        spark,
        (1, 1, "2024-05-01", "1.00", "x", "STREAMING", day), (2, 1, "2024-05-01", "1.00", "x", "STREAMING", other),
        (3, 1, "2024-05-01", "1.00", "x", "HISTORICAL", day), (4, 1, "2024-05-01", "1.00", "x", "STREAMING", None),
        (5, 1, "2024-05-01", "1.00", "x", "STREAMING", day))
    stores.create_transaction_store(rows, "store_under_test")
    assert stores.delete_streaming_rows(spark, "store_under_test", dt.date(2024, 5, 1)) == 2
    assert t.rows(spark.table("store_under_test"), "transaction_id") == [(2,), (3,), (4,)]
    assert t.rows(stores.without_streaming_day(rows, dt.date(2024, 5, 1)), "transaction_id") == [(2,), (3,), (4,)]
    assert stores.delete_streaming_rows(spark, "store_under_test", dt.date(2024, 5, 1)) == 0
    assert stores.delete_streaming_rows(spark, "store_under_test") == 0


def test_lakehouse_copy(spark, tmp_path):
    path = str(tmp_path / "copy")
    people = t.customers(spark, (1, None, "a", "b", "1"))
    stores.write_lakehouse_copy(people, path)
    assert spark.read.parquet(path).schema.simpleString() == people.schema.simpleString()
    stores.write_lakehouse_copy(people, path + "-orc", "orc")
    assert spark.read.orc(path + "-orc").count() == 1


def test_raw_to_marts_from_files(spark, tmp_path):
    """Files in, published marts out."""
    from ledgermill.operators import mortgages

    (tmp_path / "m.csv").write_text(CSV)
    (tmp_path / "c.json").write_text(
        '{"customer_id": 1001, "first_name": "a", "last_name": "b", "phone_number": "(212) 555-0101", "loan_record_id": 1}\n')
    (tmp_path / "t.json").write_text(
        '{"transaction_id": 1, "customer_id": 1001, "transaction_date": "2024-05-01", "transaction_amount": 60000,'
        ' "transaction_type": "dining", "data_source": "HISTORICAL"}\n')
    raw = models.Raw(
        files.load_customers_json(spark, str(tmp_path / "c.json")),
        mortgages.number_mortgages(files.load_mortgages_csv(spark, str(tmp_path / "m.csv"))),
        files.load_transactions_json(spark, str(tmp_path / "t.json")))
    published = models.publish(spark, raw, mart_schema="from_files")
    row = t.one(spark.table(published["customer_360"]))
    assert (row.loan_type, row.customer_tier, row.total_spent) == ("FHA-INSURED", "Premium", Decimal("60000.00"))


def test_what_is_read_from_stored_records_can_be_stored(spark):
    """Columns and structs taken straight from a stored landing table, written and read again."""
    stored = scratch(spark, "landed")
    lines = [t.envelope(1, "INSERT", "A", after=t.image("1.00")), t.envelope(2, "DELETE", "B", before=t.image("2.00"))]
    t.landed(spark, *lines).write.parquet(stored)
    landed = spark.read.parquet(stored)
    frames = [
        cdc.versions(landed), cdc.fold(cdc.versions(landed)), cdc.cdc_transactions(landed),
        cdc.cdc_parsed(landed).drop("raw_json"), cdc.cdc_as_transactions(landed), cdc.cdc_current_state(landed)]
    for frame in frames:
        path = scratch(spark, "again")
        frame.write.parquet(path)
        assert t.rows(spark.read.parquet(path)) == t.rows(frame)


def test_stream_over_stored_records(spark, tmp_path):
    from ledgermill.streaming import changes

    stored, state = str(tmp_path / "landed"), str(tmp_path / "state")
    t.landed(spark, t.envelope(1, "INSERT", "A", after=t.image("1.00"))).write.parquet(stored)
    live = spark.readStream.schema("record_content variant").parquet(stored)
    changes.keep_versions(live, state, str(tmp_path / "checkpoint")).awaitTermination()
    changes.compact_versions(spark, state)
    assert t.rows(changes.current_state(spark, state), "row_key", "transaction_amount") == [("A", Decimal("1.00"))]


def test_loads_stop_at_a_bad_row_whatever_is_read(spark, tmp_path):
    import pytest
    from ledgermill.sources import files

    header = "a,b,c,d,e,f,g,h,i,j"
    good = "2024-01-01,1,L1,t,FHA,buy,10.5,20.5,York,1"
    (tmp_path / "m.csv").write_text("\n".join([header, good, good.replace("20.5", "much")]) + "\n")
    (tmp_path / "t.json").write_text('{"transaction_id": 1, "customer_id": 2}\n{"transaction_id": 3, "customer_id": "x"}\n')
    (tmp_path / "c.json").write_text('{"customer_id": 1, "first_name": "a"}\n{"customer_id": "one"}\n')
    loads = [files.load_mortgages_csv(spark, str(tmp_path / "m.csv")), files.load_transactions_json(spark, str(tmp_path / "t.json")),
             files.load_customers_json(spark, str(tmp_path / "c.json"))]
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            for load, column in zip(loads, ("loan_id", "transaction_id", "first_name"), strict=True):
                for read in (load, load.select(column)):
                    with pytest.raises(Exception):
                        read.collect()
                with pytest.raises(Exception):
                    load.count()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
