import datetime as dt
import random
from decimal import Decimal

import frames as t
from ledgermill.operators import cdc
from ledgermill.plans import models

T0 = 1_700_000_000_000


def test_amounts_round_to_whole_units_except_in_table_shape(spark):
    events = t.landed(spark, *[t.envelope(i, "INSERT", after=t.image(a)) for i, a in
                               enumerate(["10000.49", "10000.50", "-2.50", "2.50", None])])
    assert t.rows(cdc.cdc_transactions(events), "transaction_id", "transaction_amount") == [
        (0, Decimal(10000)), (1, Decimal(10001)), (2, Decimal(-3)), (3, Decimal(3)), (4, None)]
    assert t.rows(cdc.cdc_as_transactions(events), "transaction_amount") == [
        (Decimal("-2.50"),), (Decimal("10000.49"),), (Decimal("10000.50"),), (Decimal("2.50"),), (None,)]
    assert t.rows(cdc.high_value_cdc(events), "transaction_id", "anomaly_type") == [(1, "HIGH_VALUE")]


def test_deletes_count_without_payload(spark):
    events = t.landed(
        spark,
        t.envelope(1, "INSERT", after=t.image("10.00", customer=1)),
        t.envelope(2, "INSERT", after=t.image("20.00", customer=2)),
        t.envelope(3, "DELETE", before=t.image("20.00", customer=2)),
    )
    found = {r.cdc_action: r for r in cdc.cdc_action_summary(events).collect()}
    assert tuple(found["DELETE"])[1:] == (1, 0, None, None)
    assert tuple(found["INSERT"])[1:] == (2, 2, Decimal("15.00"), Decimal(30))


def test_parsed_columns_and_milliseconds(spark):
    parsed = cdc.cdc_parsed(t.landed(spark, t.envelope(1, "INSERT", at=T0 + 123, after=t.image("1.00"))))
    assert parsed.columns == [
        "cdc_object_type", "transaction_id", "cdc_action", "source_schema", "source_table", "db_user",
        "committed_timestamp", "customer_id", "transaction_type", "transaction_amount", "transaction_date",
        "data_source", "primary_key_tokenized", "transaction_id_encrypted", "raw_json"]
    row = t.one(parsed.drop("raw_json"))
    assert row.committed_timestamp.microsecond == 123000
    assert row.transaction_date == dt.date(2024, 5, 1)


def test_records_without_action(spark):
    events = t.landed(spark, '{"object":"x"}', '{"transaction":{"transaction_id":1,"action":null}}', "7",
                      t.envelope(2, "INSERT"))
    assert cdc.cdc_total(events).first()[0] == 4
    assert cdc.cdc_parsed(events).count() == 4
    assert t.rows(cdc.cdc_transactions(events), "transaction_id") == [(2,)]


def test_recent_activity_includes_the_edge(spark):
    as_of = dt.datetime(2023, 11, 14, 23, 0)
    edge = int(dt.datetime(2023, 11, 14, 22, 0, tzinfo=dt.timezone.utc).timestamp() * 1000)
    events = t.landed(
        spark,
        t.envelope(1, "INSERT", at=edge, after=t.image("1.00")),
        t.envelope(2, "INSERT", at=edge - 1, after=t.image("1.00")),
        t.envelope(3, "UPDATE", at=edge + 7_200_000, after=t.image("2.00")),
    )
    assert t.rows(cdc.cdc_recent_activity(events, as_of), "cdc_action", "recent_transactions") == [
        ("INSERT", 1), ("UPDATE", 1)]
    zoned = as_of.replace(tzinfo=dt.timezone(dt.timedelta(hours=-3)))  # three hours later
    assert cdc.cdc_recent_activity(events, zoned).count() == 0


def test_time_without_zone_is_session_time(spark, monkeypatch):
    import time

    events = t.landed(spark, t.envelope(1, "INSERT", at=T0, after=t.image("1.00")))
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        just_after = dt.datetime(2023, 11, 14, 22, 13, 21)  # T0 is 22:13:20 UTC
        assert cdc.cdc_recent_activity(events, just_after).count() == 1
    finally:
        monkeypatch.undo()
        time.tzset()


def test_fold_takes_the_last_version(spark):
    lines = [
        t.envelope(1, "INSERT", "A", T0, after=t.image("1.00")),
        t.envelope(2, "UPDATE", "A", T0 + 5, after=t.image("2.00")),
        t.envelope(3, "INSERT", "B", T0, after=t.image("3.00")),
        t.envelope(4, "DELETE", "B", T0 + 9),
        t.envelope(5, "UPDATE", "B", T0 + 8, after=t.image("4.00")),  # late: stays deleted
        t.envelope(6, "INSERT", "C", T0, after=t.image("5.00")),
        t.envelope(7, "UPDATE", "C", T0, after=t.image("6.00")),  # same millisecond
        t.envelope(8, "INSERT", None, T0, after=t.image("7.00")),
    ]
    random.Random(1).shuffle(lines)
    found = t.rows(cdc.cdc_current_state(t.landed(spark, *lines)), "row_key", "transaction_amount", "last_event_id")
    assert found == [("A", Decimal("2.00"), 2), ("C", Decimal("6.00"), 7)]


def _breaks(events):
    """Continuity in plain Python over (key, ms, number, action, before, after) tuples."""
    last, found = {}, []
    for key, ms, number, action, before, after in sorted(events, key=lambda e: e[:3]):
        if before != last.get(key):
            found.append((key, number, key in last))
        last[key] = after
    return sorted(found, key=repr)


def test_continuity_across_blocks_with_a_hot_key(spark, shuffle_partitions):
    pick = random.Random(11)
    events, state = [], {}
    for number in range(300):
        key = "hot" if number % 3 == 0 else f"k{pick.randrange(6)}"
        amount = f"{pick.randrange(1, 5)}.00"
        held = state.get(key)
        action = "INSERT" if held is None else pick.choice(["UPDATE", "UPDATE", "DELETE"])
        before = None if action == "INSERT" else (held if pick.random() > 0.2 else "9.00")
        after = None if action == "DELETE" else amount
        state[key] = after
        events.append((key, T0 + number // 2, number, action, before, after))
    lines = [t.envelope(n, a, k, ms, before and t.image(before), after and t.image(after))
             for k, ms, n, a, before, after in events]
    pick.shuffle(lines)
    frame = t.landed(spark, *lines)
    for partitions, block in ((1, 4), (8, 7), (4, 20_000)):
        shuffle_partitions(partitions)
        found = cdc.cdc_continuity(frame, rows_per_block=block)
        assert t.rows(found, "row_key", "event_id", "has_previous") == _breaks(events)


def test_method_comparison_labels(spark):
    events = t.landed(spark, t.envelope(1, "INSERT", after=t.image("1.00")), t.envelope(2, "DELETE"))
    direct = t.transactions(spark, (1, 1, "2024-01-01", "1.00", "x", "HISTORICAL"),
                            (2, 1, "2024-01-01", "1.00", "x", "STREAMING"))
    assert [tuple(r) for r in cdc.method_comparison(events, direct).collect()] == [
        ("CDC_STREAM", 1, "STREAMING"), ("DIRECT_INSERT", 1, "HISTORICAL"), ("DIRECT_INSERT", 1, "STREAMING")]


def test_latest_rows_and_top_types(spark):
    events = t.landed(spark, *[t.envelope(i, "INSERT", at=T0 + i, after=t.image("1.00", kind=f"t{i % 7}"))
                               for i in range(25)])
    assert [r.transaction_id for r in cdc.cdc_latest_rows(events).collect()] == list(range(24, 14, -1))
    assert [r.transaction_id for r in cdc.cdc_latest_inserts(events, 3).collect()] == [24, 23, 22]
    assert [r.transaction_type for r in cdc.cdc_top_types(events).collect()] == ["t0", "t1", "t2", "t3", "t4"]


def test_views_from_sql(spark):
    models.register_cdc_views(t.landed(spark, t.envelope(1, "INSERT", after=t.image("1.00"))))
    assert spark.sql("SELECT sum(transaction_count) AS n FROM cdc_action_summary").first().n == 1


def test_rounded_mean_is_exact(spark):
    from ledgermill.functions import money
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(Decimal(x),) for x in (1, 1, 1, 1, 1, 1, 1, 2)], "a decimal(38,0)")
    mean = money.mean(F.sum("a"), F.count("a"))
    assert frame.agg(mean.alias("m")).first().m == Decimal("1.13")  # 1.125
    assert frame.where("a > 5").agg(mean.alias("m")).first().m is None
