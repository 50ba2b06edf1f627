"""Near-duplicate vectors by a subspace pigeonhole join.

Vectors of length one are rotated by a fixed random rotation and cut into SUBSPACES blocks of coordinates. If two vectors are
within a squared distance B, then in some block they are within its share of B (pigeonhole). So each block is
joined by range under its share: rows are put into cells of a grid over the block's first coordinates, as wide as the range,
and meet the rows of their own and the neighbouring cells. The union of the candidates is verified exactly.

Dense groups are not compared row by row. Rows that lie within half the range of a common hub are all linked
to each other; such a ball takes part in the join as its hub, with a budget widened by its radius. By the triangle
inequality two balls are linked as a whole, not at all, or are opened: their rows are then tested against the other ball and,
where that settles nothing either, row by row. Hubs only save work: rows that no hub holds join on their own.

Links: cosine of THRESHOLD or more in double precision. Equal vectors are one node of the join and linked to each other.

Rows: null, empty or zero vectors, or with null or non-finite components, link with nothing and are a component each. vec_id
is a key: of rows that repeat one, the smallest usable vector counts and one row is returned. Each row without vec_id is
returned with no links. Vectors of different lengths are not linked. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.llm.neardup import components
from ledgermill.llm.store import written
from ledgermill.llm.vectors import matrix

THRESHOLD = 0.9
SUBSPACES = 4
#: coordinates of a block that its grid is made of
GRID = 2
#: rows of a cell compared by one task at a time with as many others
BLOCK = 32768
#: times that every row may find a hub
ROUNDS = 6
#: coordinates of which a round's key names the two largest, one in each half: at most SIDES**2 hubs a round
SIDES = 64
#: what rounding may move a distance by
EPS = 1e-7


@lru_cache(maxsize=8)
def rotation(dim: int, number: int) -> np.ndarray:
    """A fixed random rotation of `dim` coordinates."""
    return np.linalg.qr(np.random.default_rng([dim, number]).standard_normal((dim, dim)))[0]


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_length(batch: pa.RecordBatch, *names: str) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Row numbers of one length of vectors, and these vectors of each column named as unit rows."""
    size = np.diff(np.asarray(batch.column(names[0]).offsets, np.int64))
    table = pa.Table.from_batches([batch])
    for dim in np.unique(size):
        at = np.flatnonzero(size == dim)
        yield at, [unit(matrix(table.take(at), name)) for name in names]


def _keys(nodes: DataFrame) -> DataFrame:
    """node, dim, round, key: in every round, which coordinates of a rotated vector are the largest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for at, (x,) in _by_length(batch, "embedding"):
                half = min(SIDES // 2, (x.shape[1] + 1) // 2)
                for n in range(ROUNDS):
                    z = x @ rotation(x.shape[1], 1 + n)[:, : 2 * half]
                    key = np.zeros(len(z), np.int64)
                    for part in (z[:, :half], z[:, half:]):
                        if part.shape[1]:
                            best = np.abs(part).argmax(axis=1)
                            key = key * SIDES + 2 * best + (part[np.arange(len(z)), best] < 0)
                    own = [batch.column(c).take(pa.array(at)) for c in ("node", "dim")]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(np.full(len(z), n), pa.int32()), pa.array(key)], names=["node", "dim", "round", "key"])

    return nodes.select("node", "dim", "embedding").mapInArrow(run, "node long, dim int, round int, key long")


def balls(nodes: DataFrame, radius: float) -> DataFrame:
    """node, hub, d: rows within `radius` of a hub, each with one hub; hubs are not listed.

    A key's hub is its row of smallest hash, so a round has at most SIDES**2 hubs for vectors of one length. A row takes the hub
    of smallest hash among those in reach, and hubs that are in reach of another hold no ball."""
    order = F.struct(F.xxhash64("node", F.lit(5)).alias("hash"), "node")
    keyed = written(_keys(nodes))
    hubs = written(keyed.groupBy("round", "key", "dim").agg(F.min(order).alias("hub"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    asked = keyed.join(F.broadcast(hubs), ["round", "key", "dim"]).filter("node <> hub.node")
    asked = asked.filter(F.col("hub") < order).select("node", "hub").distinct()
    named = hubs.select(F.col("hub.node").alias("node")).distinct()
    centres = nodes.join(F.broadcast(named), "node").select(F.col("node").alias("_hub"), F.col("embedding").alias("v"))
    rows = asked.join(nodes.select("node", F.col("embedding").alias("u")), "node").join(F.broadcast(centres), F.col("hub.node") == F.col("_hub"))
    near = _measured(rows.select("node", "hub", "u", "v"), "node hub", "node long, hub struct<hash: long, node: long>").filter(F.col("d") <= radius)
    near = written(near.drop("linked"))
    taken = near.select(F.col("node").alias("_hub")).distinct().join(F.broadcast(named.withColumnRenamed("node", "_hub")), "_hub")
    free = near.join(F.broadcast(taken), F.col("hub.node") == F.col("_hub"), "left_anti")
    best = free.groupBy("node").agg(F.min(F.struct("hub", "d")).alias("b"))
    return best.select("node", F.col("b.hub.node").alias("hub"), F.col("b.d").alias("d"))


def _near(left: np.ndarray, right: np.ndarray, reach: np.ndarray, more: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows that may be as near as `reach` of the left and `more` of the right one together, tile by tile.

    One product gives (limit**2 - distance**2) / 2 for a whole tile, whose size fits a core's cache."""
    half = lambda x: (x * x).sum(axis=1, keepdims=True) / 2
    limit = (reach + (more.max() if len(more) else 0.0) + 1e-4).astype(np.float32)[:, None]
    first = np.hstack([left, limit**2 / 2 - half(left), np.ones((len(left), 1), np.float32)]).astype(np.float32)
    second = np.hstack([right, np.ones((len(right), 1), np.float32), -half(right)]).astype(np.float32).T
    wide = 4096
    tiles = [np.ascontiguousarray(np.pad(second[:, at : at + wide], ((0, 0), (0, max(0, at + wide - second.shape[1]))), constant_values=-4.0)) for at in range(0, second.shape[1], wide)]
    room, hit = np.empty((256, wide), np.float32), np.empty((256, wide), bool)
    for at in range(0, len(first), 256):
        some = first[at : at + 256]
        for n, tile in enumerate(tiles):
            np.matmul(some, tile, out=room[: len(some)])
            np.greater_equal(room[: len(some)], 0, out=hit[: len(some)])
            # eight flags at a time
            eights = np.flatnonzero(hit[: len(some)].reshape(-1).view(np.uint64))
            if len(eights):
                flat = (eights[:, None] * 8 + np.arange(8)).ravel()
                flat = flat[hit.reshape(-1)[flat]]
                i, j = flat // wide + at, flat % wide + n * wide
                inside = j < len(right)
                yield i[inside], j[inside]


def _range_join(leaders: DataFrame, reach: float) -> DataFrame:
    """(a, b), a < b: leaders whose distance may be below reach + both radii, by at least one block's share of its square."""
    widest = leaders.agg(F.max("radius")).first()[0] or 0.0
    sizes = lambda dim: np.diff(np.linspace(0, dim, min(SUBSPACES, dim) + 1).astype(int))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["node", "radius", "dim", "block", "cell", "home", "part"]
        for batch in batches:
            if not batch.num_rows:
                continue
            for at, (x,) in _by_length(batch, "embedding"):
                dim = x.shape[1]
                z = x @ rotation(dim, 0)
                own = [batch.column(n).take(pa.array(at)) for n in ("node", "radius", "dim")]
                begin = 0
                for n, size in enumerate(sizes(dim).tolist()):
                    part = z[:, begin : begin + size]
                    begin += size
                    width = (reach + 2 * widest) * math.sqrt(size / dim) + EPS
                    place = np.floor(part[:, : min(GRID, size)] / width).astype(np.int64)
                    column = pa.FixedSizeListArray.from_arrays(pa.array(part.astype(np.float32).ravel()), size).cast(pa.list_(pa.float32()))
                    steps = np.stack(np.meshgrid(*[[-1, 0, 1]] * place.shape[1], indexing="ij"), -1).reshape(-1, place.shape[1])
                    # a row is at home in one cell and visits the neighbours that follow it, so two cells meet in one of them
                    for step in steps[len(steps) // 2 :]:
                        cell = ((place + step + (1 << 20)) << np.array([0, 21])[: place.shape[1]]).sum(axis=1)
                        yield pa.RecordBatch.from_arrays([*own, pa.array(np.full(len(at), n), pa.int32()), pa.array(cell), pa.array(np.full(len(at), not step.any())), column], names=names)

    def run(table: pa.Table) -> pa.Table:
        node, radius, home, lot = (np.asarray(table.column(n)) for n in ("node", "radius", "home", "lot"))
        part = matrix(table, "part", np.float32)
        low, high, dim = table.column("x")[0].as_py(), table.column("y")[0].as_py(), table.column("dim")[0].as_py()
        share = math.sqrt(part.shape[1] / dim)
        left, right = np.flatnonzero(lot == low), np.flatnonzero(lot == high)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j in _near(part[left], part[right], (reach + radius[left]) * share, radius[right] * share):
            i, j = left[i], right[j]
            apart = ((part[i].astype(float) - part[j]) ** 2).sum(axis=1)
            true = apart <= ((reach + radius[i] + radius[j]) * share + 1e-5) ** 2  # for what 32 bits round off
            good = true & (home[i] | home[j]) & ((node[i] < node[j]) if low == high else (node[i] != node[j]))
            a.append(np.minimum(node[i], node[j])[good])
            b.append(np.maximum(node[i], node[j])[good])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    schema = "node long, radius double, dim int, block int, cell long, home boolean, part array<float>"
    keys = ["dim", "block", "cell"]
    rows = leaders.select("node", "radius", "dim", "embedding").mapInArrow(cells, schema)
    # as many cells as the sphere has room for, whatever the rows
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.max(F.col("home").cast("int")).alias("homes")).filter("n > 1 AND homes = 1")
    lots = F.ceil(F.col("n") / BLOCK).cast("long")
    dealt = rows.join(F.broadcast(counts.select(*keys, "n")), keys).withColumn("lot", F.pmod(F.xxhash64("node", F.lit(BLOCK)), lots))
    each = dealt.withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), lots - 1))).withColumns({"x": F.least("lot", "_o"), "y": F.greatest("lot", "_o")})
    return each.drop("_o", "n").groupBy(*keys, "x", "y").applyInArrow(run, "a long, b long").distinct()


def _measured(pairs: DataFrame, keep: str, schema: str) -> DataFrame:
    """pairs with d, the distance of the unit vectors of u and v, and linked: a cosine of THRESHOLD or more."""
    names = keep.split()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            d, linked = np.empty(batch.num_rows), np.zeros(batch.num_rows, bool)
            table = pa.Table.from_batches([batch])
            size = np.diff(np.asarray(batch.column("u").offsets, np.int64))
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                u, v = (matrix(table.take(at), n) for n in ("u", "v"))
                d[at] = np.sqrt(((unit(u) - unit(v)) ** 2).sum(axis=1))
                u, v = (x / np.abs(x).max(axis=1, keepdims=True) for x in (u, v))
                linked[at] = (u * v).sum(axis=1) / (np.sqrt((u * u).sum(axis=1)) * np.sqrt((v * v).sum(axis=1))) >= THRESHOLD
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(d), pa.array(linked)], names=[*names, "d", "linked"])

    return pairs.mapInArrow(run, f"{schema}, d double, linked boolean")


def _rows(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding and 128 bits that tell vectors apart, of the rows that take part. Floats stay as they are."""
    kind = vectors.schema["embedding"].dataType
    vector = F.col("embedding") if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else F.col("embedding").cast("array<double>")
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("embedding"))
    good = rows.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").filter(~odd & F.exists("embedding", lambda x: x != 0))
    one = good.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return one.select("*", F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2"))


def links(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vector."""
    rows = written(_rows(vectors))
    copies = rows.groupBy("h1", "h2").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")).drop("h1", "h2")
    nodes = written(rows.join(copies, "vec_id").select(F.col("vec_id").alias("node"), "copies", F.size("embedding").alias("dim"), "embedding", "h1", "h2"))
    reach = math.sqrt(2 - 2 * threshold)
    inside = written(balls(nodes, reach / 2 - EPS))
    # sizes and radii of balls: as many as hubs, whose number has a bound
    held = inside.join(nodes.select("node", "copies"), "node").groupBy("hub").agg(F.max("d").alias("radius"), F.sum("copies").alias("others"), F.min("node").alias("least"))
    held = written(held)
    alone = nodes.join(inside.select("node"), "node", "left_anti")
    leaders = written(
        alone.join(F.broadcast(held), F.col("node") == F.col("hub"), "left").select(
            *["node", "copies", "dim", "embedding"],
            F.coalesce("radius", F.lit(0.0)).alias("radius"),
            (F.col("copies") + F.coalesce("others", F.lit(0))).alias("weight"),
            F.least("node", "least").alias("least"),
            F.col("hub").isNotNull().alias("ball"),
        )
    )
    side = lambda end, vector: leaders.select(F.col("node").alias(end), F.col("embedding").alias(vector), *[F.col(c).alias(f"{end}_{c}") for c in ("radius", "copies", "weight", "ball")])
    met = written(_range_join(leaders, reach + EPS)).join(side("a", "u"), "a").join(side("b", "v"), "b")
    names = "a b a_copies b_copies a_radius b_radius a_ball b_ball a_weight b_weight"
    kinds = "a long, b long, a_copies long, b_copies long, a_radius double, b_radius double, a_ball boolean, b_ball boolean, a_weight long, b_weight long"
    met = _measured(met, names, kinds)
    met = written(met.filter(F.col("d") - F.col("a_radius") - F.col("b_radius") <= reach + EPS))
    single = met.filter("NOT a_ball AND NOT b_ball AND linked")
    wide = met.filter("a_ball OR b_ball")
    whole = F.col("d") + F.col("a_radius") + F.col("b_radius") <= reach - EPS

    # balls that are neither linked as a whole nor apart: rows of the first against the second ball
    opened = wide.filter(~whole)
    rows_of = inside.select("hub", "node").union(leaders.select(F.col("node").alias("hub"), "node"))
    vector = lambda name: nodes.select("node", F.col("embedding").alias(name), "copies")
    first = opened.select("a", "b", "b_radius", "b_weight").join(rows_of.withColumnRenamed("hub", "a"), "a").join(vector("u"), "node")
    first = first.join(leaders.select(F.col("node").alias("b"), F.col("embedding").alias("v")), "b")
    tested = _measured(first, "a b node copies b_radius b_weight", "a long, b long, node long, copies long, b_radius double, b_weight long")
    tested = written(tested.filter(F.col("d") - F.col("b_radius") <= reach + EPS))
    all_of_b = F.col("d") + F.col("b_radius") <= reach - EPS
    # what that leaves open: row by row
    last = tested.filter(~all_of_b).select("a", "b", F.col("node").alias("x"), F.col("copies").alias("x_copies"))
    last = last.join(rows_of.select(F.col("hub").alias("b"), F.col("node").alias("y")), "b")
    last = last.join(vector("u").select(F.col("node").alias("x"), "u"), "x").join(vector("v").select(F.col("node").alias("y"), "v", F.col("copies").alias("y_copies")), "y")
    exact = _measured(last, "a b x y x_copies y_copies", "a long, b long, x long, y long, x_copies long, y_copies long")
    exact = written(exact.filter("linked"))

    # links of whole balls (by hub) and of single rows (by node)
    joined = wide.filter(whole)
    of_hub = (
        joined.select(F.col("a").alias("node"), F.col("b_weight").alias("n"))
        .union(joined.select("b", "a_weight"))
        .union(tested.filter(all_of_b).select("b", "copies"))
        .union(single.select("a", "b_copies"))
        .union(single.select("b", "a_copies"))
    )
    of_hub = of_hub.groupBy(F.col("node").alias("hub")).agg(F.sum("n").alias("by_hub"))
    of_row = (
        tested.filter(all_of_b).select("node", F.col("b_weight").alias("n")).union(exact.select("x", "y_copies")).union(exact.select("y", "x_copies")).groupBy("node").agg(F.sum("n").alias("by_row"))
    )
    edges = joined.select("a", "b").union(single.select("a", "b")).union(tested.filter(all_of_b).select("a", "b")).union(exact.select("a", "b")).distinct()
    classes = components(edges)

    named = leaders.join(classes, "node", "left").withColumn("class_", F.coalesce("class_", "node"))
    smallest = written(named.groupBy("class_").agg(F.min("least").alias("component_id")))
    ends = written(named.join(smallest, "class_").join(of_hub.withColumnRenamed("hub", "node"), "node", "left").select("node", "ball", "component_id", (F.col("weight") - 1 + F.coalesce("by_hub", F.lit(0))).alias("n")))
    in_ball = inside.join(F.broadcast(ends.filter("ball").withColumnRenamed("node", "hub")), "hub").select("node", "component_id", "n")
    by_node = ends.select("node", "component_id", "n").union(in_ball).join(of_row, "node", "left")
    by_node = by_node.join(nodes.select("node", "h1", "h2"), "node").select("h1", "h2", "component_id", (F.col("n") + F.coalesce("by_row", F.lit(0))).alias("n_links"))
    found = rows.select("vec_id", "h1", "h2").join(by_node, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    every = ids.filter("vec_id IS NOT NULL").distinct().join(found, "vec_id", "left")
    every = every.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    nameless = ids.filter("vec_id IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return every.union(nameless).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


#: DuckDB SQL for links(): every two vectors, and paths over their links
SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT vec_id, x, sqrt(list_inner_product(x, x)) AS size FROM v WHERE list_inner_product(x, x) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
    WHERE list_inner_product(a.x, b.x) / (a.size * b.size) >= {THRESHOLD}),
r(vec_id, reached) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.reached = l.a),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a),
c AS (SELECT vec_id, min(reached) AS component_id FROM r GROUP BY vec_id)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)"""
