import datetime as dt
import json
from decimal import Decimal

import frames as t
import pytest
from ledgermill.operators import cdc
from ledgermill.sources import files
from ledgermill.streaming import changes, payments, sinks

T0 = 1_700_000_000_000


def _feed(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def _payment(number, amount="12.50", anomaly=False, **other):
    row = {"transaction_id": number, "customer_id": 1001, "transaction_date": "2024-05-01",
           "transaction_amount": float(amount), "transaction_type": "dining", "is_anomaly": anomaly}
    return json.dumps({**row, **other})


def test_payments_once_over_restarts(spark, tmp_path):
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    for round_, lines in enumerate([[_payment(1), "{cut"], [_payment(2), _payment(3, customer_id=None)], []]):
        _feed(tmp_path / "in", f"{round_}.json", *lines)
        payments.append_transactions(payments.feed(spark, str(tmp_path / "in")), table, checkpoint).awaitTermination()
    stored = spark.read.parquet(table)
    assert t.rows(stored, "transaction_id", "transaction_amount", "data_source") == [
        (1, Decimal("12.50"), "STREAMING"), (2, Decimal("12.50"), "STREAMING")]
    assert stored.where("ingestion_timestamp IS NULL OR created_at IS NULL").count() == 0


def test_delete_a_day_of_the_live_store(spark, tmp_path):
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")

    def stream(name, *numbers):
        _feed(tmp_path / "in", name, *[_payment(n) for n in numbers])
        payments.append_transactions(payments.feed(spark, str(tmp_path / "in")), table, checkpoint).awaitTermination()

    stream("0.json", 1, 2)
    payments.open_store(spark, table)
    payments.open_store(spark, table)
    assert payments.read_store(spark, table).count() == 2
    assert payments.delete_day(spark, table, dt.date(2020, 1, 1)) == 0
    today = spark.sql("SELECT current_date()").first()[0]
    assert payments.delete_day(spark, table) == 2
    assert payments.read_store(spark, table).count() == 0
    stream("1.json", 3)
    assert t.rows(payments.read_store(spark, table), "transaction_id") == [(3,)]
    assert payments.delete_day(spark, table, today) == 1
    assert payments.delete_day(spark, table, today) == 0


def test_counters_run_on(spark, tmp_path):
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    for round_, lines in enumerate([[_payment(1, anomaly=True), "{cut"], [_payment(2), _payment(3)]]):
        _feed(tmp_path / "in", f"{round_}.json", *lines)
        payments.keep_counters(payments.feed(spark, str(tmp_path / "in")), table, checkpoint).awaitTermination()
    row = t.one(payments.latest_counters(spark, table))
    # each file ends in a line end, so the totals are the lines written
    assert tuple(row) == (4, 3, 1, 1, Decimal("75.0"), Decimal("25.0"))


def test_rates_without_rows(spark):
    totals = payments.counters(spark.createDataFrame([], "value string"))
    assert tuple(t.one(payments.with_rates(totals)))[4:] == (Decimal("0.0"), Decimal("0.0"))


def _land(spark, tmp_path):
    lines = payments.feed(spark, str(tmp_path / "in"))
    outs = [str(tmp_path / name) for name in ("landed", "rejects", "checkpoint")]
    for query in changes.land(lines, *outs):
        query.awaitTermination()
    return outs


def test_landing_keeps_bad_lines_apart(spark, tmp_path):
    good = [t.envelope(i, "INSERT", after=t.image("1.00")) for i in (1, 2)]
    _feed(tmp_path / "in", "a.json", good[0], "{cut")
    _land(spark, tmp_path)
    _feed(tmp_path / "in", "b.json", good[1])
    landed, rejects, _ = _land(spark, tmp_path)
    assert t.rows(cdc.cdc_transactions(spark.read.parquet(landed)), "transaction_id") == [(1,), (2,)]
    assert t.rows(spark.read.parquet(rejects)) == [("{cut",)]


def _stream(spark, tmp_path):
    return files.landed(payments.feed(spark, str(tmp_path / "in"), files_per_batch=1))


def test_summaries_equal_batch_over_many_batches(spark, tmp_path):
    lines = [t.envelope(i, ["INSERT", "UPDATE", "DELETE"][i % 3], after=None if i % 3 == 2 else
                        t.image(f"{i}.50", customer=i % 4, kind=f"t{i % 2}")) for i in range(40)]
    table, checkpoint = str(tmp_path / "sums"), str(tmp_path / "checkpoint")
    for part in range(4):
        _feed(tmp_path / "in", f"{part}.json", *lines[part::4])
        if part % 2:
            changes.keep_partial_sums(_stream(spark, tmp_path), table, checkpoint).awaitTermination()
            if part == 1:
                changes.compact_sums(spark, table)
    landed = t.landed(spark, *lines)
    assert t.rows(changes.action_summary(spark, table)) == t.rows(cdc.cdc_action_summary(landed))
    assert t.rows(changes.type_summary(spark, table)) == t.rows(cdc.cdc_transaction_types(landed))


def test_batch_written_again_counts_once(spark, tmp_path):
    table = str(tmp_path / "sums")
    batch = changes.partial_sums(t.landed(spark, t.envelope(1, "INSERT", after=t.image("1.00"))))
    from pyspark.sql import functions as F

    for _ in range(2):
        sinks.write_batch(batch.withColumns({"level": F.lit("changes"), "query": F.lit("q"), "batch": F.lit(0)}), table, *sinks.LAYOUT)
    sinks.write_batch(batch.withColumns({"level": F.lit("changes"), "query": F.lit("q"), "batch": F.lit(1)}), table, *sinks.LAYOUT)
    assert t.one(changes.action_summary(spark, table)).transaction_count == 2


def test_state_with_late_events_and_snapshots(spark, tmp_path):
    table, checkpoint = str(tmp_path / "state"), str(tmp_path / "checkpoint")
    batches = [
        [t.envelope(1, "INSERT", "A", T0, after=t.image("1.00")), t.envelope(2, "INSERT", "B", T0, after=t.image("2.00"))],
        [t.envelope(4, "DELETE", "B", T0 + 9), t.envelope(3, "UPDATE", "A", T0 + 5, after=t.image("3.00"))],
        [t.envelope(5, "UPDATE", "B", T0 + 8, after=t.image("4.00")), t.envelope(6, "UPDATE", "A", T0 + 4, after=t.image("5.00"))],
        [t.envelope(7, "INSERT", "C", T0 + 20, after=t.image("6.00"))],
    ]
    everything = []
    for number, lines in enumerate(batches):
        everything += lines
        _feed(tmp_path / "in", f"{number}.json", *lines)
        changes.keep_versions(_stream(spark, tmp_path), table, checkpoint).awaitTermination()
        if number == 1:
            covered = changes.compact_versions(spark, table)
            assert changes.compact_versions(spark, table) == covered
        expected = t.rows(cdc.cdc_current_state(t.landed(spark, *everything)))
        assert t.rows(changes.current_state(spark, table)) == expected
    changes.compact_versions(spark, table)
    assert t.rows(changes.current_state(spark, table), "row_key", "transaction_amount") == [
        ("A", Decimal("3.00")), ("C", Decimal("6.00"))]


def test_no_usable_rows_yet(spark, tmp_path):
    _feed(tmp_path / "in", "0.json", '{"object":"x"}')
    for keep, name in ((changes.keep_versions, "state"), (changes.keep_partial_sums, "sums")):
        keep(_stream(spark, tmp_path), str(tmp_path / name), str(tmp_path / f"{name}-checkpoint")).awaitTermination()
    assert changes.current_state(spark, str(tmp_path / "state")).count() == 0
    assert changes.action_summary(spark, str(tmp_path / "sums")).count() == 0
    assert changes.compact_versions(spark, str(tmp_path / "state")) is None


def test_windows_drop_late_rows(spark, tmp_path):
    hour = 3_600_000
    table, checkpoint = str(tmp_path / "recent"), str(tmp_path / "checkpoint")
    start = T0 - T0 % hour
    _feed(tmp_path / "in", "0.json", t.envelope(1, "INSERT", at=start + 1000, after=t.image("10.00")),
          t.envelope(2, "INSERT", at=start + 4 * hour, after=t.image("20.00")))
    sinks.append(changes.recent_activity(_stream(spark, tmp_path)), table, checkpoint).awaitTermination()
    _feed(tmp_path / "in", "1.json", t.envelope(3, "INSERT", at=start + 2000, after=t.image("99.00")),
          t.envelope(4, "INSERT", at=start + 9 * hour, after=t.image("30.00")))
    sinks.append(changes.recent_activity(_stream(spark, tmp_path)), table, checkpoint).awaitTermination()
    found = spark.read.parquet(table)
    assert found.count() == 24  # twelve windows for each of the first two events in time
    assert {tuple(r) for r in found.select("recent_transactions", "avg_amount").distinct().collect()} == {
        (1, Decimal("10.00")), (1, Decimal("20.00"))}


def test_high_value_live(spark, tmp_path):
    _feed(tmp_path / "in", "0.json", t.envelope(1, "INSERT", after=t.image("10000.50")),
          t.envelope(2, "UPDATE", after=t.image("10000.49")), t.envelope(3, "DELETE"))
    table = str(tmp_path / "high")
    query = sinks.append(changes.high_value(_stream(spark, tmp_path)), table, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert sinks.rows_read(query) == 3
    assert t.rows(spark.read.parquet(table), "transaction_id") == [(1,)]


def test_one_bad_value_does_not_stop_a_live_query(spark, tmp_path):
    bad = t.envelope(1, "INSERT", after={**t.image("1.00"), "transaction_amount": "a lot", "customer_id": "x"})
    _feed(tmp_path / "in", "0.json", bad, t.envelope(2, "INSERT", after=t.image("20000.00")))
    table = str(tmp_path / "high")
    sinks.append(changes.high_value(_stream(spark, tmp_path)), table, str(tmp_path / "checkpoint")).awaitTermination()
    assert t.rows(spark.read.parquet(table), "transaction_id") == [(2,)]
    with pytest.raises(Exception):
        cdc.cdc_transactions(t.landed(spark, bad)).collect()


def test_a_new_checkpoint_adds_to_the_table(spark, tmp_path):
    table = str(tmp_path / "sums")
    for n in (1, 2):
        _feed(tmp_path / f"in{n}", "0.json", t.envelope(n, "INSERT", after=t.image("1.00")))
        lines = payments.feed(spark, str(tmp_path / f"in{n}"), files_per_batch=1)
        changes.keep_partial_sums(files.landed(lines), table, str(tmp_path / f"checkpoint{n}")).awaitTermination()
        changes.compact_sums(spark, table)
        assert t.one(changes.action_summary(spark, table)).transaction_count == n


def test_folders_stay_bounded_over_compactions(spark, tmp_path):
    from pyspark.sql import functions as F

    table, total = str(tmp_path / "sums"), 0
    batch = changes.partial_sums(t.landed(spark, t.envelope(1, "INSERT", after=t.image("1.00"))))
    for number in range(12):
        for query in ("a", "b"):
            place = {"level": F.lit("changes"), "query": F.lit(query), "batch": F.lit(number).cast("bigint")}
            sinks.write_batch(batch.withColumns(place), table, *sinks.LAYOUT)
            total += 1
        covered = changes.compact_sums(spark, table)
        assert covered == ({"a": number - 1, "b": number - 1} if number else None)
        assert t.one(changes.action_summary(spark, table)).transaction_count == total
    assert len(list((tmp_path / "sums").glob("level=*/query=*/batch=*"))) <= 8


def test_a_batch_under_way_survives_a_deletion(spark, tmp_path):
    """Rows stamped before the deletion whose micro-batch commits after it stay."""
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    _feed(tmp_path / "in", "0.json", _payment(1))
    payments.append_transactions(payments.feed(spark, str(tmp_path / "in")), table, checkpoint).awaitTermination()
    payments.open_store(spark, table)
    before = spark.read.parquet(table).first()
    assert payments.delete_day(spark, table) == 1
    late = spark.createDataFrame([before]).drop("transaction_id").selectExpr("7 AS transaction_id", "*")
    _feed(tmp_path / "in", "1.json", _payment(7))
    lines = payments.feed(spark, str(tmp_path / "in"))
    rows = payments.with_ingest_date(payments.stored_rows(lines).withColumn("ingestion_timestamp", payments.F.lit(late.first().ingestion_timestamp)))
    sinks.append(rows, table, checkpoint, None, payments.STORE_LAYOUT).awaitTermination()
    assert t.rows(payments.read_store(spark, table), "transaction_id") == [(7,)]


ODD_TIMES = [9 * 10**18, -(9 * 10**18), "soon", None]


def test_impossible_commit_times_stop_no_live_query(spark, tmp_path):
    lines = [t.envelope(10 + n, "INSERT", f"K{n}", at, after=t.image("20000.00")) for n, at in enumerate(ODD_TIMES)]
    lines += [t.envelope(20, "UPDATE", "K0", T0, after=t.image("30000.00"))]
    _feed(tmp_path / "in", "0.json", *lines)
    landed, rejects, _ = _land(spark, tmp_path)
    assert spark.read.parquet(landed).count() == 5 and spark.read.parquet(rejects).count() == 0
    assert spark.read.parquet(landed).where("commit_date IS NULL").count() == 4
    out = {name: str(tmp_path / name) for name in ("high", "recent", "state", "moments")}
    for live, name in ((changes.high_value, "high"), (changes.recent_activity, "recent")):
        sinks.append(live(_stream(spark, tmp_path)), out[name], str(tmp_path / f"{name}-c")).awaitTermination()
    for keep, name in ((changes.keep_versions, "state"), (changes.keep_moments, "moments")):
        keep(_stream(spark, tmp_path), out[name], str(tmp_path / f"{name}-c")).awaitTermination()
    assert spark.read.parquet(out["high"]).count() == 5
    state = changes.current_state(spark, out["state"])
    assert t.rows(state, "row_key", "transaction_amount") == [
        ("K0", Decimal("30000.00")), *[(f"K{n}", Decimal("20000.00")) for n in (1, 2, 3)]]
    recent = changes.last_hours(spark, out["moments"], dt.datetime.fromtimestamp(T0 / 1000, dt.timezone.utc))
    assert t.rows(recent) == [("UPDATE", 1, Decimal("30000.00"))]


def test_last_hour_counts_late_events(spark, tmp_path):
    as_of = dt.datetime.fromtimestamp(T0 / 1000, dt.timezone.utc)
    table, checkpoint, everything = str(tmp_path / "moments"), str(tmp_path / "checkpoint"), []
    for number, minutes in enumerate([(0, 59), (60, 61), (30, 3)]):
        lines = [t.envelope(10 * number + m, ["INSERT", "UPDATE"][m % 2], at=T0 - m * 60_000, after=t.image(f"{m}.00")) for m in minutes]
        everything += lines
        _feed(tmp_path / "in", f"{number}.json", *lines)
        changes.keep_moments(_stream(spark, tmp_path), table, checkpoint).awaitTermination()
        changes.compact_moments(spark, table)
        batch = cdc.cdc_recent_activity(t.landed(spark, *everything), as_of)
        assert t.rows(changes.last_hours(spark, table, as_of)) == t.rows(batch)
