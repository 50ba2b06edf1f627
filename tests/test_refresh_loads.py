"""Marts that follow changes, loading files once, SQL functions."""

import random
from decimal import Decimal

import frames as t
import pytest
from ledgermill.operators import cdc, marts, quality, staging
from ledgermill.plans import models, refresh, sql_functions
from ledgermill.session import folders
from ledgermill.sources import files, loads, versioned
from pyspark.sql import functions as F


def _row(number, customer, day, amount, kind="dining"):
    return (number, customer, day, amount, kind, "STREAMING")


def _staged(spark, *rows):
    return staging.stg_transactions(t.transactions(spark, *rows))


def _changes(spark, *pairs):
    """Pairs of rows (old or None, new or None)."""
    shape = _staged(spark).schema
    sides = []
    for side in (0, 1):
        rows = _staged(spark, *[p[side] for p in pairs if p[side]])
        name = ("old", "new")[side]
        other = ("new", "old")[side]
        sides.append(rows.select(F.struct(*rows.columns).alias(name)).withColumn(other, F.lit(None).cast(shape)).select("old", "new"))
    return sides[0].unionByName(sides[1])


def _stg(spark, rows):
    people = [(c, c if c % 2 else None, f"f{c}", "l", "1") for c in range(8)] + [(3, 3, "f3", "l", "1")]
    return {
        "stg_customers": staging.stg_customers(t.customers(spark, *people)),
        "stg_mortgages": staging.stg_mortgages(t.mortgages(spark, *[t.mortgage(k) for k in (1, 3, 5, 5)])),
        "stg_transactions": _staged(spark, *rows),
    }


def test_refreshed_marts_equal_rebuilt_ones(spark, tmp_path):
    """Days of inserts, updates that move between groups, and deletes of the largest and last rows."""
    rng, path = random.Random(4), str(tmp_path / "marts")
    days = ["2024-01-05", "2024-01-31", "2024-02-01", "2024-03-15", None]
    new = lambda n: _row(n, rng.choice([None, *range(8)]), rng.choice(days), rng.choice([None, "1.00", "1.00", "999.99", "6000.00", "12000.00"]), rng.choice(["a", "b"]))
    rows = {n: new(n) for n in range(60)}
    refresh.build(_stg(spark, rows.values()), path, 4)
    for day in range(3):
        pairs = []
        for n in rng.sample(sorted(rows), 12):
            old = rows.pop(n)
            if rng.random() < 0.6:
                rows[n] = new(n)
            pairs.append((old, rows.get(n)))
        for n in range(100 * (day + 1), 100 * (day + 1) + 8):
            rows[n] = new(n)
            pairs.append((None, rows[n]))
        stg = _stg(spark, rows.values())
        assert refresh.refresh(_changes(spark, *pairs), stg["stg_transactions"], path, 4) == day + 2
        assert t.rows(refresh.stored_summary(spark, path)) == t.rows(marts.transaction_summary(stg["stg_transactions"]).select(*refresh.stored_summary(spark, path).columns))
        assert t.rows(refresh.stored_customer_360(spark, path, buckets=4)) == t.rows(models.customer_360(stg))
        one = refresh.stored_customer_360(spark, path, [3, 6], buckets=4)
        assert t.rows(one) == t.rows(models.customer_360(stg).where("customer_id IN (3, 6)"))


def test_refresh_reads_and_writes_only_what_changes_touch(spark, tmp_path):
    path = str(tmp_path / "marts")
    rows = [_row(n, n % 8, f"2024-{1 + n % 6:02}-10", "5.00") for n in range(48)]
    refresh.build(_stg(spark, rows), path, 8)
    old = rows[0]
    changed = _row(0, old[1], "2024-01-11", "7.00")
    refresh.refresh(_changes(spark, (old, changed)), _staged(spark, changed, *rows[1:]), path, 8)
    rewritten = [f for f in folders(spark, f"{path}/sums") if "version=2" in folders(spark, f"{path}/sums/{f}")]
    assert rewritten == ["transaction_month=2024-01-01"]
    assert len([f for f in folders(spark, f"{path}/spend") if "version=2" in folders(spark, f"{path}/spend/{f}")]) == 1
    opened = refresh.stored_customer_360(spark, path, [0], buckets=8)
    files_read = {f for f in opened._jdf.inputFiles()}
    assert len({f.split("/bucket=")[1].split("/")[0] for f in files_read if "/bucket=" in f}) == 1


def test_refresh_run_again_after_a_failure(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "marts")
    rows = [_row(n, n % 8, "2024-01-10", "5.00") for n in range(16)]
    refresh.build(_stg(spark, rows), path, 4)
    pair, after = (rows[0], _row(0, 0, "2024-02-01", "9.00")), [_row(0, 0, "2024-02-01", "9.00"), *rows[1:]]
    finish = versioned.finish
    for broken in ("sums", "spend"):

        def fails(s, p, n, broken=broken):
            if p.endswith(broken):
                raise OSError("lost")
            finish(s, p, n)

        monkeypatch.setattr(versioned, "finish", fails)
        with pytest.raises(OSError):
            refresh.refresh(_changes(spark, pair), _staged(spark, *after), path, 4)
    monkeypatch.setattr(versioned, "finish", finish)
    refresh.refresh(_changes(spark, pair), _staged(spark, *after), path, 4)
    assert t.rows(refresh.stored_customer_360(spark, path, buckets=4)) == t.rows(models.customer_360(_stg(spark, after)))


def test_versions_of_partitions(spark, tmp_path):
    path, shape = str(tmp_path / "v"), "k string, x bigint"
    write = lambda rows, values, n: versioned.replace(spark.createDataFrame(rows, shape), path, "k", values, n)
    assert versioned.read(spark, path, shape, "k").count() == 0
    write([("a", 1), ("b/c", 2), (None, 3)], ["a", "b/c", None], 1)
    assert versioned.read(spark, path, shape, "k").count() == 0  # not finished
    versioned.finish(spark, path, 1)
    write([("b/c", 7)], ["b/c", "a"], 2)
    assert t.rows(versioned.read(spark, path, shape, "k"), "x") == [(1,), (2,), (3,)]
    versioned.finish(spark, path, 2)
    assert t.rows(versioned.read(spark, path, shape, "k"), "x") == [(3,), (7,)]  # a is empty now
    assert t.rows(versioned.read(spark, path, shape, "k", ["b/c"]), "x") == [(7,)]
    assert t.rows(versioned.read(spark, path, shape, "k", [None]), "x") == [(3,)]
    for n in (3, 4):
        write([("a", n)], ["a"], n)
        versioned.finish(spark, path, n)
    versioned.tidy(spark, path, "k")
    assert folders(spark, f"{path}/k=a") == ["version=4", "version=3"] or sorted(folders(spark, f"{path}/k=a")) == ["version=3", "version=4"]
    assert t.rows(versioned.read(spark, path, shape, "k"), "x") == [(3,), (4,), (7,)]


# loads


def _line(n):
    return f'{{"transaction_id":{n},"customer_id":1,"transaction_date":"2024-01-01","transaction_amount":1.5,"transaction_type":"x","data_source":"S"}}\n'


def test_each_file_is_loaded_once(spark, tmp_path):
    folder, table = tmp_path / "in", str(tmp_path / "table")
    folder.mkdir()
    load = lambda n=10_000: loads.load_new(spark, str(folder), table, files.load_transactions_json, n)
    ids = lambda: [r[0] for r in t.rows(loads.loaded_rows(spark, table), "transaction_id")]
    (folder / "a.json").write_text(_line(1) + _line(2))
    (folder / "b.json").write_text(_line(3))
    assert load() == 2 and load() == 0
    assert ids() == [1, 2, 3]
    (folder / "c.json").write_text(_line(4))
    (folder / "d.json").write_text(_line(5))
    assert load(1) == 2  # a load for each
    assert ids() == [1, 2, 3, 4, 5]
    assert t.rows(loads.load_report(spark, table), "load", "files") == [(1, 2), (2, 1), (3, 1)]
    (folder / "b.json").write_text(_line(3) + _line(6))  # changed: loaded again
    assert load() == 1 and ids() == [1, 2, 3, 3, 4, 5, 6]


def test_a_load_that_stops_counts_for_nothing(spark, tmp_path, monkeypatch):
    folder, table = tmp_path / "in", str(tmp_path / "table")
    folder.mkdir()
    (folder / "a.json").write_text(_line(1))
    (folder / "b.json").write_text('{"transaction_id":"many"}\n')
    load = lambda: loads.load_new(spark, str(folder), table, files.load_transactions_json)
    with pytest.raises(Exception):
        load()
    assert loads.loaded_files(spark, table).count() == 0
    (folder / "b.json").write_text(_line(2))
    monkeypatch.setattr(loads, "make_folder", lambda *a: (_ for _ in ()).throw(OSError("lost")))  # rows and ledger written, no mark
    with pytest.raises(OSError):
        load()
    monkeypatch.undo()
    assert load() == 2
    assert t.rows(loads.loaded_rows(spark, table), "transaction_id") == [(1,), (2,)]


# SQL


def test_metric_scan_from_sql(spark):
    rows = t.transactions(spark, (1, 1, "2024-01-01", "1.00", "  ", "S"), (2, None, "2024-01-01", "1.00", "x", "S"), (3, 3, None, "1.00", None, "S"))
    rows.createOrReplaceTempView("scanned")
    scan = sql_functions.metric_scan_function(spark, "scanned")
    found = spark.sql(f"SELECT * FROM {scan}('core.Blank_Count', 'TRANSACTION_TYPE')")
    assert t.rows(found) == t.rows(quality.metric_scan(rows, "core.blank_count", "transaction_type"))
    assert t.rows(spark.sql(f"SELECT transaction_id FROM {scan}('null_count', 'customer_id') JOIN scanned USING (transaction_id)")) == [(2,)]
    for wrong in ("('blank_count', 'nothing')", "('other', 'transaction_type')"):
        with pytest.raises(Exception, match="no such metric"):
            spark.sql(f"SELECT * FROM {scan}{wrong}").collect()


def test_metric_scan_is_one_pushed_condition(spark, tmp_path):
    t.transactions(spark, (1, 1, "2024-01-01", "1.00", "x", "S")).write.parquet(str(tmp_path / "t"))
    spark.read.parquet(str(tmp_path / "t")).createOrReplaceTempView("scanned_files")
    scan = sql_functions.metric_scan_function(spark, "scanned_files")
    text = spark.sql(f"SELECT transaction_id FROM {scan}('null_count', 'customer_id')")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNull(customer_id)]" in text


def test_one_policy_changes_every_view(spark):
    t.customers(spark, (1, None, "a", "Smith", "212-555-1234"), (2, None, "b", None, None)).createOrReplaceTempView("people")
    sql_functions.create_role_variable(spark)
    sql_functions.create_policies(spark)
    attached = [(v, c, p) for v in ("people_a", "people_b") for _, c, p in sql_functions.ATTACHED]
    sql_functions.masked_views(spark, {"people_a": "people", "people_b": "people"}, attached)
    shown = lambda view: t.rows(spark.table(view), "last_name", "phone_number")
    for view in ("people_a", "people_b"):
        assert shown(view) == [("***", "***-***-1234"), ("***", None)]
    spark.sql("SET VAR reader_role = 'Data_Steward'")
    assert shown("people_a") == [("Smith", "212-555-1234"), (None, None)]
    spark.sql("SET VAR reader_role = 'accountadmin'")
    sql_functions.create_policy(spark, "mask_last_name", "concat(left(value, 1), '.')")
    for view in ("people_a", "people_b"):
        assert shown(view) == [("S.", "***-***-1234"), (None, None)]
    with pytest.raises(ValueError):
        sql_functions.masked_views(spark, {"people_a": "people"}, [("people_a", "nothing", "mask_last_name")])
    with pytest.raises(ValueError):
        sql_functions.masked_views(spark, {}, attached)
    sql_functions.create_policies(spark)


# plans named weak


def test_current_state_picks_rows_before_the_shuffle(spark):
    landed = t.landed(spark, t.envelope(1, "INSERT", after=t.image("1.00")))
    text = cdc.cdc_current_state(landed)._jdf.queryExecution().toString()
    assert "SortAggregate" not in text and text.count("WindowGroupLimit") >= 2


def test_continuity_moves_no_images(spark):
    landed = t.landed(spark, t.envelope(1, "INSERT", after=t.image("1.00")), t.envelope(2, "UPDATE", at=1_700_000_000_001, before=t.image("2.00"), after=t.image("2.00")))
    found = cdc.cdc_continuity(landed)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "transaction_id_encrypted" not in text
    row = t.one(found)
    assert (row.expected_amount, row.found_amount, row.has_previous) == (Decimal("1.00"), Decimal("2.00"), True)


def test_total_of_a_load_has_no_narrow_cap(spark):
    rows = spark.createDataFrame([(Decimal("99999999.99"), False)] * 3, "transaction_amount decimal(10,2), is_anomaly boolean")
    total = quality.load_summary(rows)
    assert dict(total.dtypes)["total_amount"] == "decimal(38,2)" and t.one(total).total_amount == Decimal("299999999.97")
