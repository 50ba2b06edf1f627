"""Removal of word sequences that occur more than once, by difference-cover anchors.

Positions whose remainder modulo PERIOD lies in COVER are anchors. Any two remainders differ by a difference of two
members of COVER, so for every two places there is a shift below PERIOD that makes both anchors. A window of
PERIOD + w - 1 words that occurs twice therefore shares an anchor of w words at an aligned place in both. Anchors alone
are hashed and matched over the corpus; only round anchors that match are whole windows compared (by 96 bits).

What a task sees twice itself it marks at once and sends on once, so a passage shared by a third of all documents costs
one entry per task and not one per document. Answers go back to documents by a key of the row, never by value lists.

Rows: null text holds no words; texts shorter than a window stay whole; words keep their form. Repeated rows are each
other's repeats, null doc_id is allowed, other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.arrays import Words, mix, slices, spans_hash
from ledgermill.llm.store import keyed

WINDOW = 35
#: a difference cover: every remainder modulo PERIOD is a difference of two members (fixed values of the method)
PERIOD = 21
COVER = (3, 6, 7, 12, 14)
#: entries that a task gathers before it sends them on
BATCH = 1_500_000
#: letters of text whose entries make one deal; a deal holds about a byte for each
DEAL = 32 << 20
_U = np.uint64
_SECOND = 0xA0761D6478BD642F

_SENT = "deal long, hash binary, more binary, row binary, at binary, sole binary"
_ANSWERS = "to long, row binary, at binary"


class _Outbox:
    """Entries (hash, more, row key, place in the row) on their way to where equal hashes meet.

    Entries that are equal within a batch are answered at once; one of them is sent on, without an address."""

    def __init__(self, deals: int):
        self.deals, self.held, self.count = deals, [], 0

    def add(self, hashes: np.ndarray, more: np.ndarray, row: np.ndarray, at: np.ndarray) -> bool:
        """True when the batch is full."""
        self.held.append((hashes, more.astype(np.uint32), row, at.astype(np.int32)))
        self.count += len(hashes)
        return self.count >= BATCH

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.count:
            return
        hashes, more, row, at = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.count = [], 0
        order = np.lexsort((at, row, more, hashes))
        hashes, more, row, at = (x[order] for x in (hashes, more, row, at))
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (more[1:] != more[:-1])
        sole = new & np.append(new[1:], True)
        known = ~sole  # equal rows give equal answers; one is enough
        known[1:] &= new[1:] | (row[1:] != row[:-1]) | (at[1:] != at[:-1])
        sent, known = np.flatnonzero(new), np.flatnonzero(known)
        deal = np.concatenate([hashes[sent] % _U(self.deals), _U(self.deals) + _place(row[known], self.deals)]).astype(np.int64)
        keep = np.concatenate([sent, known])
        by = np.lexsort((row[keep], deal))
        deal, keep = deal[by], keep[by]
        cuts = np.flatnonzero(np.diff(deal, prepend=-1))
        parts = np.split(keep, cuts[1:])
        columns = [pa.array([x[p].tobytes() for p in parts], pa.binary()) for x in (hashes, more, row, at, sole)]
        yield pa.RecordBatch.from_arrays([pa.array(deal[cuts], pa.int64()), *columns], names=["deal", "hash", "more", "row", "at", "sole"])


def _place(row: np.ndarray, deals: int) -> np.ndarray:
    return mix(row.view(np.uint64)) % _U(deals)


def _joined(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _repeated(sent: DataFrame, deals: int) -> DataFrame:
    """k1 and the distinct places (little-endian 32-bit) of the row's entries whose hash occurs more than once."""

    def meet(table: pa.Table) -> pa.Table:
        row, at = _joined(table, "row", np.int64), _joined(table, "at", np.int32)
        if table.column("deal")[0].as_py() < deals:
            hashes, more, sole = _joined(table, "hash", np.uint64), _joined(table, "more", np.uint32), _joined(table, "sole", bool)
            order = np.lexsort((more, hashes))
            hashes, more = hashes[order], more[order]
            same = (hashes[1:] == hashes[:-1]) & (more[1:] == more[:-1])
            back = order[np.append(same, False) | np.insert(same, 0, False)]
            back = back[sole[back]]
            row, at = row[back], at[back]
        to = _place(row, deals).astype(np.int64)
        order = np.lexsort((at, row, to))
        row, at, to = row[order], at[order], to[order]
        cuts = np.flatnonzero(np.diff(to, prepend=-1))
        split = [pa.array([x.tobytes() for x in np.split(y, cuts[1:])] if len(cuts) else [], pa.binary()) for y in (row, at)]
        return pa.table([pa.array(to[cuts], pa.int64()), *split], names=["to", "row", "at"])

    def gather(table: pa.Table) -> pa.Table:
        row, at = _joined(table, "row", np.int64), _joined(table, "at", np.int32)
        order = np.lexsort((at, row))
        row, at = row[order], at[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1])
        row, at = row[new], at[new]
        cuts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        places = pa.array([x.tobytes() for x in np.split(at, cuts[1:])], pa.binary())
        return pa.table([pa.array(row[cuts], pa.int64()), places], names=["k1", "places"])

    answers = sent.groupBy("deal").applyInArrow(meet, _ANSWERS)
    return answers.groupBy("to").applyInArrow(gather, "k1 long, places binary")


def _anchors(docs: DataFrame, width: int, deals: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box = _Outbox(deals)
        for batch in slices(batches):
            words = Words(batch.column("text"))
            place = np.arange(len(words)) - words.first[words.row]
            room = words.first[words.row + 1] - np.arange(len(words))
            here = np.flatnonzero(np.isin(place % PERIOD, COVER) & (room >= width))
            hashes = words.windows(words.hashes(), width, here)
            row = np.asarray(batch.column("k1"))[words.row[here]]
            if box.add(hashes, np.zeros(len(here)), row, place[here]):
                yield from box.flush()
        yield from box.flush()

    return docs.mapInArrow(run, _SENT)


def _windows(docs: DataFrame, window: int, deals: int) -> DataFrame:
    """Whole windows around the repeated anchors of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box = _Outbox(deals)
        for batch in slices(batches):
            words = Words(batch.column("text"))
            anchors = [np.frombuffer(x, np.int32) for x in batch.column("places").to_pylist()]
            size = np.diff(words.first)
            owner = np.repeat(np.arange(len(size)), [len(x) for x in anchors])
            at = np.concatenate(anchors).astype(np.int64)
            low, high = np.maximum(at - PERIOD + 1, 0), np.minimum(at, size[owner] - window)
            good = high >= low
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, (words.first[owner] + low)[good], 1)
            np.add.at(edge, (words.first[owner] + high + 1)[good], -1)
            here = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
            hashes = words.windows(words.hashes(), window, here)
            # from hashes of its own: words that one hash takes for equal are told apart by the other
            more = spans_hash(words.hashes(other=True), here, here + window, _SECOND) & _U(0xFFFFFFFF)
            row = words.row[here]
            if box.add(hashes, more, np.asarray(batch.column("k1"))[row], here - words.first[row]):
                yield from box.flush()
        yield from box.flush()

    # the order of rows decides what a batch holds; it must be the same when a task runs again
    return docs.sortWithinPartitions("k1").mapInArrow(run, _SENT)


def _kept(text: str | None, places: bytes | None, window: int) -> tuple[int, int, bytes]:
    words = (text or "").encode().split()
    if not places:
        return len(words), 0, b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.frombuffer(places, np.int32)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    stay = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    return len(words), len(words) - len(stay), b" ".join([words[i] for i in stay.tolist()])


def _shaped(docs: DataFrame, window: int, column: str, show) -> DataFrame:
    """show: turns the kept words, joined by spaces in UTF-8, into the value of the last column."""
    if window < PERIOD:
        raise ValueError(f"a window needs {PERIOD} words at least")
    rows = keyed(docs).select("k1", "doc_id", "text")
    # a deal meets in one task, so their number follows the text
    letters = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    deals = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-letters // DEAL))
    anchors = _repeated(_anchors(rows.select("k1", "text"), window - PERIOD + 1, deals), deals)
    # both joins deal the rows by k1, so Spark moves the texts once and reads that shuffle twice
    windows = _repeated(_windows(rows.join(anchors, "k1"), window, deals), deals)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = [_kept(t, p, window) for t, p in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist(), strict=True)]
            n, removed, kept = zip(*got, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array([show(k) for k in kept], pa.string())],
                names=["doc_id", "n_words", "n_removed", column.split()[0]],
            )

    return rows.join(windows, "k1", "left").mapInArrow(run, f"doc_id long, n_words long, n_removed long, {column}")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by one space."""
    return _shaped(docs, window, "kept string", lambda kept: kept.decode("utf-8", "replace"))


def digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """remove_repeats() with the lower-case hex SHA-256 of the kept words in their place."""
    return _shaped(docs, window, "kept_sha256 string", lambda kept: hashlib.sha256(kept).hexdigest())


#: DuckDB SQL for digests(): every window of the corpus by its words (doc_id is a key there)
SQL = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW} + 2)) AS i FROM w),
h AS (SELECT doc_id, i, array_to_string(ws[i:i + {WINDOW} - 1], ' ') AS win FROM p),
twice AS (SELECT win FROM h GROUP BY win HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS j FROM h JOIN twice USING (win)),
k AS (SELECT w.doc_id, u.j, ws[u.j] AS word FROM w, LATERAL (SELECT unnest(range(1, len(ws) + 1)) AS j) u),
stay AS (SELECT k.doc_id, string_agg(word, ' ' ORDER BY k.j) AS kept, count(*) AS n
    FROM k LEFT JOIN gone ON k.doc_id = gone.doc_id AND k.j = gone.j WHERE gone.j IS NULL GROUP BY k.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN stay USING (doc_id)"""
