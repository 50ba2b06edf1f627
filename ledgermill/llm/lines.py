"""Removal of repeated runs of lines, by prefix doubling over the sequence of line ids.

The suffixes of all documents' line sequences are ordered by their first line, then by their first 2, 4, 8, ... lines: the
pair (rank here, rank so many lines on) is the next key. Ranks are places in the order over the whole corpus, found by
range partitioning and running sums. Suffixes whose key is their own are settled and leave; the others are the intervals
of the suffix array whose longest common prefix is at least that long. Doubling ends when no interval is left, so
a run of n lines takes about log2(n) rounds, each over what is still shared. Intervals of MIN_LINES lines and more hold the
copies of one run: all but the first in the order of doc_id and line are later copies, and a line goes if a later copy
covers it. Of each suffix the deepest interval in which it is a later copy is kept.

Blank lines are no part of a sequence and are never removed. Lines compare by 128 bits of their exact text.
Rows: null text holds one blank line; of rows equal in doc_id and text the first counts, the others are later copies;
null doc_id comes first; other columns are kept as they are. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermill.llm.store import held, keyed, written

MIN_LINES = 2
_BLANK = " \t\r"


def _sequence(text: Column) -> Column:
    """(i, x): number and text of each line that is not blank."""
    every = F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    return F.filter(every, lambda l: F.trim(l["x"], F.lit(_BLANK)) != "")


def _ranked(groups: DataFrame, keys: list[str]) -> DataFrame:
    """groups with rank: how many suffixes come before, in the order of the keys over all groups. n: a group's size.

    Each range partition sums up its own part; only one total for each goes to a single task."""
    parts = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # ranges are drawn from a sample, so they are fixed by writing them down
    slabs = written(groups.repartitionByRange(parts, *keys).withColumn("slab", F.spark_partition_id()))
    totals = slabs.groupBy("slab").agg(F.sum("n").alias("total"))
    before = totals.withColumn("before", F.sum("total").over(Window.orderBy("slab")) - F.col("total")).drop("total")
    own = F.sum("n").over(Window.partitionBy("slab").orderBy(*keys)) - F.col("n")
    return slabs.join(F.broadcast(before), "slab").withColumn("rank", F.col("before") + own).drop("slab", "before", "n")


def intervals(rows: DataFrame, min_lines: int = MIN_LINES) -> list[tuple[int, DataFrame]]:
    """(depth, suffixes) of every round from `min_lines` on: k1, k2, at (place in the row's sequence), rank of the interval, and
    first, the earliest of its suffixes as (doc_id, k1, k2, at). Depths are `min_lines` times 1, 2, 4, ... rows: as keyed()
    gives them."""
    lines = rows.select("k1", "k2", "doc_id", F.posexplode(F.transform(_sequence(F.col("text")), lambda l: l["x"])).alias("at", "body"))
    now = lines.select("k1", "k2", "doc_id", "at", F.xxhash64("body").alias("a"), F.xxhash64("body", F.lit(1)).alias("b"))
    keys, depth = ["a", "b"], 1  # hashes of a line at first, then ranks of a run and of the run behind it
    here = F.struct("doc_id", "k1", "k2", "at")
    found = []
    while True:
        again = now.groupBy(*keys).agg(F.count("*").alias("n"), F.min(here).alias("first")).filter("n > 1")
        ranked = written(now.join(_ranked(again, keys), keys).select("k1", "k2", "doc_id", "at", "rank", "first"))
        if ranked.isEmpty():
            return found
        if depth >= min_lines:
            found.append((depth, ranked))
        step = depth if depth >= min_lines else min(depth, min_lines - depth)
        ahead = Window.partitionBy("k1", "k2").orderBy("at").rangeBetween(step, step)
        # where a sequence ends before, or goes on with a settled suffix, no longer run starts
        now = ranked.drop("first").withColumn("b", F.max("rank").over(ahead)).filter("b IS NOT NULL").withColumnRenamed("rank", "a")
        depth += step


def later_copies(rows: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """k1, k2 and places: where, in the row's sequence, a later copy starts, and the lines of the deepest interval it is one of."""
    here = F.struct("doc_id", "k1", "k2", "at")
    later = None
    for depth, shared in intervals(rows, min_lines):
        own = shared.filter(~here.eqNullSafe(F.col("first"))).select("k1", "k2", "at", F.lit(depth).alias("lines"))
        later = own if later is None else later.unionByName(own)
    if later is None:
        return rows.sparkSession.createDataFrame([], "k1 long, k2 long, places array<struct<at: int, lines: int>>")
    deepest = later.groupBy("k1", "k2", "at").agg(F.max("lines").alias("lines"))
    return deepest.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("at", "lines"))).alias("places"))


def _kept(text: str | None, places: list[dict] | None, copy: int, min_lines: int) -> tuple[list[str], list[tuple[int, int]]]:
    """Lines that stay, and the maximal removed runs as (first line number, lines)."""
    every = (text or "").split("\n")
    if not places and copy == 1:
        return every, []
    sequence = [i for i, x in enumerate(every) if x.strip(_BLANK)]
    if copy > 1:
        taken = range(len(sequence)) if len(sequence) >= min_lines else ()
    else:
        taken, past = [], 0  # places come in order, so what one covers beyond the last is all that is new
        for p in places or []:
            taken += range(max(past, p["at"]), p["at"] + p["lines"])
            past = max(past, p["at"] + p["lines"])
    gone = [sequence[n] for n in taken]
    place = {i: n for n, i in enumerate(sequence)}
    runs: list[tuple[int, int]] = []
    for i in gone:
        if runs and place[i] == place[runs[-1][0]] + runs[-1][1]:
            runs[-1] = (runs[-1][0], runs[-1][1] + 1)
        else:
            runs.append((i, 1))
    out = set(gone)
    return [x for i, x in enumerate(every) if i not in out], runs


def _joined(docs: DataFrame, min_lines: int) -> DataFrame:
    """row, places, copy (1 for the first of equal rows)."""
    copy = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("k1"))
    rows = held(docs).withColumn("copy", copy)
    return rows.join(later_copies(keyed(docs), min_lines), ["k1", "k2"], "left").select("row", "places", "copy")


def _each(texts: list, batch: pa.RecordBatch, min_lines: int) -> list[tuple[list[str], list[tuple[int, int]]]]:
    columns = (batch.column(c).to_pylist() for c in ("places", "copy"))
    return [_kept(t, p, c, min_lines) for t, p, c in zip(texts, *columns, strict=True)]


def without_repeats(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """The same rows and columns; text has lost the lines of later copies. Texts that lose nothing stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(names, batch.column("row").flatten(), strict=True))
            old = columns["text"].to_pylist()
            got = _each(old, batch, min_lines)
            columns["text"] = pa.array(["\n".join(lines) if runs else o for (lines, runs), o in zip(got, old, strict=True)], columns["text"].type)
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    names = docs.columns
    return _joined(docs, min_lines).mapInArrow(run, docs.schema)


def runs(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """doc_id, n_lines, n_removed, n_runs, longest_run, kept_sha256 (kept lines joined by line ends) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = _each(batch.column("text").to_pylist(), batch, min_lines)
            removed = [sum(n for _, n in r) for _, r in got]
            values = [
                [len(lines) + n for (lines, _), n in zip(got, removed, strict=True)],
                removed,
                [len(r) for _, r in got],
                [max((n for _, n in r), default=0) for _, r in got],
            ]
            digests = [hashlib.sha256("\n".join(lines).encode()).hexdigest() for lines, _ in got]
            columns = [batch.column("doc_id"), *(pa.array(v, pa.int64()) for v in values), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_lines", "n_removed", "n_runs", "longest_run", "kept_sha256"])

    rows = _joined(docs, min_lines).select(F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.text").alias("text"), "places", "copy")
    return rows.mapInArrow(run, "doc_id long, n_lines long, n_removed long, n_runs long, longest_run long, kept_sha256 string")


#: DuckDB SQL for runs(): pairs of following lines (doc_id is a key there)
SQL = """
WITH l AS (SELECT doc_id, i, ls[i] AS x FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p FROM l WHERE trim(x, ' ' || chr(9) || chr(13)) <> ''),
n AS (SELECT *, lead(x) OVER w AS y, lead(i) OVER w AS j FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
later AS (SELECT doc_id, i, j FROM (SELECT *, row_number() OVER (PARTITION BY x, y ORDER BY doc_id, p) AS nth FROM n WHERE y IS NOT NULL) WHERE nth > 1),
gone AS (SELECT doc_id, i FROM later UNION SELECT doc_id, j FROM later),
run AS (SELECT doc_id, g, count(*) AS size FROM (SELECT s.doc_id, p - row_number() OVER (PARTITION BY s.doc_id ORDER BY p) AS g
    FROM s JOIN gone USING (doc_id, i)) GROUP BY doc_id, g),
r AS (SELECT doc_id, count(*) AS n_runs, max(size) AS longest FROM run GROUP BY doc_id),
k AS (SELECT l.doc_id, count(*) AS n_lines, count(gone.i) AS n_removed,
    coalesce(string_agg(x, chr(10) ORDER BY l.i) FILTER (WHERE gone.i IS NULL), '') AS kept
    FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i GROUP BY l.doc_id)
SELECT doc_id, n_lines, n_removed, coalesce(n_runs, 0)::BIGINT AS n_runs, coalesce(longest, 0)::BIGINT AS longest_run,
    sha256(kept) AS kept_sha256 FROM k LEFT JOIN r USING (doc_id)"""
