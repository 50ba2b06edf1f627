"""Personal data: fixed patterns, and terms that disclose what they found, in DataFrame functions only.

Each distinct value that a pattern finds is a protected entity. A context is a line. Over all lines of the corpus,
IC(e) = log(N / n(e)) is what an entity's appearance tells, and PMI(e, t) = log(N n(e, t) / (n(e) n(t))) what a term tells
about it; n counts lines, copies included. A term whose PMI reaches the share REMOVE of IC gives the entity away and
is removed from the entity's lines; from GENERALISE on it is replaced by its kind of word. One line proves nothing: the
pair must stand in MIN_CONTEXTS different lines. Lines without a pattern's match are left as they are.

Rows: null text is empty; repeated rows give a row each, null doc_id is allowed, other columns are ignored or, in
sanitised(), kept; an empty table gives an empty result. Patterns never match across lines. They use possessive
repeats and start only where a run of their characters starts, so very long texts take linear time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermill.llm.store import held, keyed, released, written

REMOVE = 0.95
GENERALISE = 0.8
MIN_CONTEXTS = 2
_SPAN = ("order", "start", "end", "kind", "value", "share", "reach")
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: the same matches as the patterns of each kind, leftmost and not overlapping, before their checks
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: a line without this holds no match of the kind
_SIGNS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
_ANY_SIGN = r"@|[0-9][ .-]?[0-9]|\+[0-9]"
_NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


def _passes(kind: Column, value: Column) -> Column:
    """The check of a kind on a matched string."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    count = F.length(digits)
    # twice every second digit from the right, less 9 above 9
    at = F.sequence(F.lit(1), count)
    digit = lambda i: F.substring(digits, i, F.lit(1)).cast("int")
    luhn = F.aggregate(
        F.transform(at, lambda i: F.when((count - i) % 2 == 1, digit(i) * 2 - F.when(digit(i) > 4, 9).otherwise(0)).otherwise(digit(i))),
        F.lit(0),
        lambda a, x: a + x,
    )
    return (
        F.when(kind == "ip", F.regexp_like(value, F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$")))
        .when(kind == "card", count.between(16, 19) & F.when(count.between(16, 19), luhn % 10 == 0))
        .when(kind == "phone", count.between(8, 15))
        .otherwise(F.lit(True))
    )


def _cut(text: Column, pattern: str) -> Column:
    """(n, before, value) of every match of a pattern: the length of what stands between it and the match before, and
    its text."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    return F.transform(values, lambda v, n: F.struct(n.alias("n"), F.get(gaps, n).alias("before"), v.alias("value")))


def _placed(matches: DataFrame, by: list[str]) -> DataFrame:
    """start and end of each match in its text, from the lengths before and of every match up to it."""
    past = F.sum(F.col("m.before") + F.length("m.value")).over(Window.partitionBy(*by).orderBy("m.n"))
    return matches.withColumn("end", past).withColumn("start", F.col("end") - F.length("m.value")).withColumn("value", F.col("m.value"))


def _lines(rows: DataFrame) -> DataFrame:
    """k1, k2, line, offset, body, times: each line with a sign of some kind, of rows that have one. Equal rows are
    taken once; times counts them."""
    split = rows.filter(F.regexp_like("text", F.lit(_ANY_SIGN))).select("k1", "k2", F.posexplode(F.split("text", "\n", -1)).alias("line", "body"))
    signed = F.when(F.regexp_like("body", F.lit(_ANY_SIGN)), F.col("body"))
    once = split.groupBy("k1", "k2", "line").agg(F.max(F.length("body")).alias("size"), F.max(signed).alias("body"), F.count("*").alias("times"))
    past = Window.partitionBy("k1", "k2").orderBy("line")
    return once.withColumn("offset", F.sum(F.col("size") + 1).over(past) - F.col("size") - 1).filter("body IS NOT NULL").drop("size")


def base_spans(lines: DataFrame) -> DataFrame:
    """k1, k2, line, offset, kind, start, end (in the line), value of every match that passes its check."""
    none = F.array().cast("array<struct<n:int,before:int,value:string>>")
    found = [
        F.struct(F.lit(k).alias("kind"), F.when(F.regexp_like("body", F.lit(_SIGNS[k])), _cut(F.col("body"), PATTERNS[k])).otherwise(none).alias("all")) for k in KINDS
    ]
    each = lines.select("k1", "k2", "line", "offset", F.explode(F.array(*found)).alias("f"))
    each = each.select("k1", "k2", "line", "offset", F.col("f.kind").alias("kind"), F.explode("f.all").alias("m"))
    placed = _placed(each, ["k1", "k2", "line", "kind"])
    return placed.filter(_passes(F.col("kind"), F.col("value"))).select("k1", "k2", "line", "offset", "kind", "start", "end", "value")


def _terms(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """k1, k2, line, offset, term, start, end: every word of the entities' lines, outside the matches themselves."""
    covered = spans.groupBy("k1", "k2", "line").agg(F.collect_list(F.struct("start", "end")).alias("covered"))
    # lines are few bytes and much work each, so their number of tasks is not left to their size
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = lines.repartition(tasks, "k1", "k2", "line").join(covered, ["k1", "k2", "line"])
    each = own.select("k1", "k2", "line", "offset", "covered", F.explode(_cut(F.col("body"), _WORD)).alias("m"))
    placed = _placed(each, ["k1", "k2", "line"])
    outside = ~F.exists("covered", lambda c: (c["start"] < F.col("end")) & (F.col("start") < c["end"]))
    return placed.filter(outside).select("k1", "k2", "line", "offset", F.lower("value").alias("term"), "start", "end", "value")


def _lines_with(rows: DataFrame) -> DataFrame:
    """term and the number of lines of the corpus that hold it."""
    line = F.explode(F.split("text", "\n", -1)).alias("body")
    words = F.array_distinct(F.split(F.lower("body"), _NO_WORD))
    return rows.select(line).select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))


def disclosing(rows: DataFrame, lines: DataFrame, spans: DataFrame) -> DataFrame:
    """k1, k2, line, offset, kind ('term'), start, end, value, share of the terms that give an entity of their line away.

    share: the largest PMI(e, t) / IC(e) of the line's entities, GENERALISE at least."""
    entities = spans.select("k1", "k2", "line", F.concat_ws(":", "kind", F.lower("value")).alias("entity")).distinct()
    terms = written(_terms(lines, spans))  # read three times below
    lines_of = F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1
    total = rows.agg(F.sum(lines_of)).first()[0]
    where = lines.select("k1", "k2", "line", "times", F.xxhash64("body").alias("context")).join(entities, ["k1", "k2", "line"])
    n_entity = where.groupBy("entity").agg(F.sum("times").alias("n_entity"))
    # entities of one context alone drop out before their terms are looked at
    contexts = where.select("entity", "context").distinct().groupBy("entity").count().filter(F.col("count") >= MIN_CONTEXTS)
    several = where.join(contexts.select("entity"), "entity")
    own = several.join(terms.select("k1", "k2", "line", "term").distinct(), ["k1", "k2", "line"])
    pairs = (
        own.groupBy("entity", "term", "context")
        .agg(F.sum("times").alias("times"))
        .groupBy("entity", "term")
        .agg(F.sum("times").alias("n_pair"), F.count("*").alias("contexts"))
        .filter(F.col("contexts") >= MIN_CONTEXTS)
    )
    known = pairs.join(_lines_with(rows), "term").join(n_entity, "entity").withColumn("n", F.lit(total))
    ic = F.log(F.col("n") / F.col("n_entity"))
    pmi = F.log(F.col("n") * F.col("n_pair") / (F.col("n_entity") * F.col("n_term")))
    strong = known.select("entity", "term", F.when(ic > 0, pmi / ic).alias("share")).filter(F.col("share") >= GENERALISE)
    # by entity and term: a line meets only the terms that it holds
    hits = own.join(strong, ["entity", "term"]).groupBy("k1", "k2", "line", "term").agg(F.max("share").alias("share"))
    return terms.join(hits, ["k1", "k2", "line", "term"]).select("k1", "k2", "line", "offset", F.lit(TERM).alias("kind"), "start", "end", "value", "share")


def spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with keys, and k1, k2, spans (array of kind, start, end in the text, value, share; patterns by kind as
    listed, then terms, each by start) of the rows that have some."""
    rows = keyed(docs).select("k1", "k2", "doc_id", "text")
    lines = written(_lines(rows))
    base = written(base_spans(lines))
    every = base.withColumn("share", F.lit(None).cast("double")).unionByName(disclosing(rows, lines, base))
    order = F.create_map(*[x for n, k in enumerate([*KINDS, TERM]) for x in (F.lit(k), F.lit(n))])
    at = every.select("k1", "k2", order[F.col("kind")].alias("order"), (F.col("offset") + F.col("start")).alias("start"), (F.col("offset") + F.col("end")).alias("end"), "kind", "value", "share")
    past = Window.partitionBy("k1", "k2").orderBy("start", "order").rowsBetween(Window.unboundedPreceding, -1)
    reach = at.withColumn("reach", F.coalesce(F.max("end").over(past), F.lit(0).cast("long")))  # where earlier spans end
    return rows, reach.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct(*_SPAN))).alias("spans"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans as text, n_term."""
    rows, found = spans(docs)
    all_ = F.coalesce("spans", F.array().cast("array<struct<order:int,start:bigint,end:bigint,kind:string,value:string,share:double,reach:bigint>>"))
    own = rows.drop("text").join(found, ["k1", "k2"], "left").withColumn("spans", all_)
    text = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    of = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.array_join(F.transform(F.filter("spans", lambda x: x["kind"] != TERM), text), ",")
    return own.select("doc_id", *[of(k) for k in KINDS], F.sha2(base, 256).alias("base_sha256"), F.array_join(F.transform("spans", text), ",").alias("spans"), of(TERM))


def sanitised(docs: DataFrame) -> DataFrame:
    """The same rows and columns with the spans of `text` replaced: patterns by their kind in brackets, disclosing
    terms by their kind of word, or by nothing where they give the entity away."""
    found = spans(docs)[1].select("k1", "k2", F.array_sort(F.transform("spans", _replacement)).alias("spans"))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    # what stands between the spans before and this one, then its replacement; inside an earlier span: nothing
    piece = lambda s: F.when(
        s["start"] >= s["reach"], F.concat(F.substring(text, s["reach"].cast("int") + 1, (s["start"] - s["reach"]).cast("int")), s["shown"])
    ).otherwise("")
    end = F.array_max(F.transform("spans", lambda s: s["end"])).cast("int")
    clean = F.concat(F.array_join(F.transform("spans", piece), ""), F.substring(text, end + 1, F.length(text)))
    joined = held(docs).join(found, ["k1", "k2"], "left")
    return released(joined, docs, F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(clean))


def _replacement(span: Column) -> Column:
    shape = F.when(F.regexp_like(span["value"], F.lit("^[0-9]+$")), "[number]").otherwise("[word]")
    shown = F.when(span["kind"] != TERM, F.concat(F.lit("["), span["kind"], F.lit("]"))).when(span["share"] >= REMOVE, F.lit("")).otherwise(shape)
    return F.struct(span["start"].alias("start"), span["order"].alias("order"), span["end"].alias("end"), span["reach"].alias("reach"), shown.alias("shown"))
