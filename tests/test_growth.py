"""Work that must not grow faster than the tables."""

from ledgermill.plans import checks, refresh
from ledgermill.sources import given
from ledgermill.streaming import payments

FOLDER = "/root/testdata/sf0.001"


def test_feed_files_grow_in_number_not_in_size(spark, monkeypatch):
    rows = given.events(spark, FOLDER).count()
    monkeypatch.setattr(given, "FILE_ROWS", rows // 9 + 1)
    given_path = []
    monkeypatch.setattr(given, "scratch", lambda s, label, own=given.scratch: given_path.append(own(s, label)) or given_path[-1])
    given.events_stream(spark, FOLDER, 3)
    stored = spark.read.parquet(given_path[0])
    sizes = [r["count"] for r in stored.groupBy("_metadata.file_path").count().collect()]
    assert len(sizes) == 9 and sum(sizes) == rows and max(sizes) <= rows // 9 + 2


def test_channel_feed_of_many_files_keeps_its_batches(spark, monkeypatch):
    monkeypatch.setattr(given, "FILE_ROWS", max(1, given.events(spark, FOLDER).count() // 6))
    taken = []
    monkeypatch.setattr(payments, "feed", lambda s, f, files_per_batch=None, own=payments.feed: taken.append(files_per_batch) or own(s, f, files_per_batch))
    got = {r.channel: (r.committed_offset, r.records) for r in checks.REGISTRY["channel_offsets"](spark, FOLDER).collect()}
    assert min(taken) >= 3 and sum(n for _, n in got.values()) == given.events(spark, FOLDER).count()


def test_changes_are_worked_out_once(spark, monkeypatch):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    own = refresh.refresh
    sizes = []

    def watched(changes, *rest):
        sizes.append(changes.count())
        return own(changes.mapInArrow(counted, changes.schema), *rest)

    monkeypatch.setattr(refresh, "refresh", watched)
    checks._refreshed(spark, FOLDER)
    assert read.value == sizes[0] > 0
