"""Mixing sources to target weights by a min-cost flow.

A document may belong to several sources. Documents are summed up by membership pattern (the set of their sources); a
flow then carries token capacity from patterns to the sources' quotas. The k-th copy of a pattern's tokens costs k - 1, so
repetition is spread evenly and used only where a quota needs it. A pattern's flow becomes whole copies of all its
documents plus a seeded share: documents in the order of a keyed hash up to the rest, and one more that fits the gap best.

The graph has one node for each pattern and source; ``max_patterns`` bounds what reaches the driver. Documents themselves
never do: their order is cut in buckets of about ``bucket_rows`` rows, whose sums give the bucket of the cut, in which
alone documents are put in order.

Cases: a null text has size 0; null is a source of its own, last in order; documents of no words take nothing; repeated
rows count each; without any words all targets are 0. The names of the added columns replace those of the input.
"""

from __future__ import annotations

from fractions import Fraction
from heapq import heappop, heappush

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
MAX_COPIES = 2
SEED = "mix-1"
BUCKET_ROWS = 10_000
MAX_PATTERNS = 50_000


def level_targets(sizes: list[int], weights: list[int], share: Fraction = SHARE, most: int = MAX_COPIES) -> list[Fraction]:
    """``share`` of all sizes dealt by weight; what is above ``most`` times a size goes to the others by weight."""
    left, open_, out = share * sum(sizes), set(range(len(sizes))), [Fraction(0)] * len(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        deal = {i: left * weights[i] / total for i in open_}
        full = {i for i in open_ if deal[i] > most * sizes[i]}
        for i in full:
            out[i] = Fraction(most * sizes[i])
        if not full:
            for i in open_:
                out[i] = deal[i]
            break
        left -= sum(out[i] for i in full)
        open_ -= full
    return out


def min_cost_flow(supplies: list[int], members: list[list[int]], quotas: list[int], max_copies: int = MAX_COPIES) -> list[list[int]]:
    """``flow[p][j]``: tokens of pattern p for its j-th source. Successive shortest paths with potentials.

    Arcs: start -> pattern once per copy (capacity: its tokens; cost: copies before), pattern -> source, source -> end (quota).
    """
    n_p, n_s = len(supplies), len(quotas)
    start, end = n_p + n_s, n_p + n_s + 1
    arcs: list[list[int]] = []  # head, capacity left, cost; arc i ^ 1 is its reverse
    out: list[list[int]] = [[] for _ in range(end + 1)]

    def arc(a, b, capacity, cost):
        out[a].append(len(arcs))
        arcs.append([b, capacity, cost])
        out[b].append(len(arcs))
        arcs.append([a, 0, -cost])

    routes = []
    for p, supply in enumerate(supplies):
        for copy in range(max_copies):
            arc(start, p, supply, copy)
        routes.append([])
        for s in members[p]:
            routes[p].append(len(arcs))
            arc(p, n_p + s, supply * max_copies, 0)
    for s, quota in enumerate(quotas):
        arc(n_p + s, end, quota, 0)
    potential = [0] * (end + 1)
    while True:
        distance, by = [None] * (end + 1), [-1] * (end + 1)
        distance[start] = 0
        heap = [(0, start)]
        while heap:
            d, a = heappop(heap)
            if d > distance[a]:
                continue
            for i in out[a]:
                b, capacity, cost = arcs[i]
                if capacity > 0:
                    new = d + cost + potential[a] - potential[b]
                    if distance[b] is None or new < distance[b]:
                        distance[b], by[b] = new, i
                        heappush(heap, (new, b))
        if distance[end] is None:
            return [[arcs[i ^ 1][1] for i in route] for route in routes]
        potential = [h + (distance[v] if distance[v] is not None else distance[end]) for v, h in enumerate(potential)]
        room, at = None, end
        while at != start:
            room = arcs[by[at]][1] if room is None else min(room, arcs[by[at]][1])
            at = arcs[by[at] ^ 1][0]
        at = end
        while at != start:
            arcs[by[at]][1] -= room
            arcs[by[at] ^ 1][1] += room
            at = arcs[by[at] ^ 1][0]


def _source_order(name: str | None):
    return (name is None, (name or "").encode())


def sized(docs: DataFrame, text: str = "text", sources=None, seed: str = SEED) -> DataFrame:
    """Add ``size`` and the keys of the selection: ``_pattern`` (the set of sources) and ``_order`` (a seeded hash)."""
    sources = F.array(F.col("source")) if sources is None else sources
    identity = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return docs.withColumns(
        {
            "size": common.word_count(F.col(text)),
            "_pattern": F.to_json(F.array_sort(F.array_distinct(sources)), {"ignoreNullFields": "false"}),
            "_order": F.md5(F.concat(F.lit(seed + ":"), identity)),
        }
    )


def plan(keys: DataFrame, weights=WEIGHTS, share: Fraction = SHARE, bucket_rows: int = BUCKET_ROWS, max_patterns: int = MAX_PATTERNS) -> DataFrame:
    """From ``_pattern, _order, doc_id, size``: one row per pattern with its targets, copies and the cut of its order."""
    import json

    spark = keys.sparkSession
    sums = keys.groupBy("_pattern").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).limit(max_patterns + 1).collect()
    if len(sums) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns; give coarser sources or a higher max_patterns")
    sums.sort(key=lambda r: r["_pattern"])
    patterns = [json.loads(r["_pattern"]) for r in sums]
    names = sorted({s for p in patterns for s in p}, key=_source_order)
    place = {s: i for i, s in enumerate(names)}
    source_sizes = [0] * len(names)
    for r, p in zip(sums, patterns):
        for s in p:
            source_sizes[place[s]] += r["size"]
    dealt = [weights[i % len(weights)] for i in range(len(names))]
    total = sum(r["size"] for r in sums)
    targets = level_targets(source_sizes, dealt, share * total / (sum(source_sizes) or 1))
    quotas = [int(t + Fraction(1, 2)) for t in targets]
    flow = min_cost_flow([r["size"] for r in sums], [[place[s] for s in p] for p in patterns], quotas)
    rows = []
    for r, p, f in zip(sums, patterns, flow):
        copies, rest = divmod(sum(f), r["size"]) if r["size"] else (0, 0)
        own = place[p[0]] if len(p) == 1 else None
        rows.append((r["_pattern"], copies, rest, max(1, -(-r["rows"] // bucket_rows)), source_sizes[own] if own is not None else None, float(targets[own]) if own is not None else None))
    schema = "_pattern string, _copies long, _rest long, _buckets long, source_size long, target double"
    table = F.broadcast(spark.createDataFrame(rows, schema))  # at most max_patterns rows
    spread = keys.join(table, "_pattern").withColumn("_bucket", _bucket())
    bucket_sums = spread.groupBy("_pattern", "_bucket", "_rest").agg(F.sum("size").alias("size"))
    up_to = Window.partitionBy("_pattern").orderBy("_bucket")
    crossing = (
        bucket_sums.withColumn("_end", F.sum("size").over(up_to))
        .where((F.col("_end") > F.col("_rest")) & (F.col("_end") - F.col("size") <= F.col("_rest")))
        .select("_pattern", "_bucket", (F.col("_end") - F.col("size")).alias("_before"))
    )  # one row per pattern at most
    inside = spread.join(F.broadcast(crossing), ["_pattern", "_bucket"])
    in_order = Window.partitionBy("_pattern").orderBy("_order", F.asc_nulls_first("doc_id"), "size", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    reached = inside.withColumn("_reached", F.col("_before") + F.sum("size").over(in_order)).where(F.col("_reached") <= F.col("_rest"))
    cuts = reached.groupBy("_pattern").agg(F.max(F.struct("_reached", *_place())).alias("_last"))
    cuts = crossing.join(cuts, "_pattern", "left").select(
        "_pattern",
        F.coalesce("_last._reached", "_before").alias("_filled"),
        "_last",
        F.col("_bucket").alias("_cut_bucket"),
    )
    cuts = common.materialise(cuts, "mix-cuts")
    rest = spread.join(F.broadcast(cuts), "_pattern").where(~_within())
    gap = F.col("_rest") - F.col("_filled")
    off = F.abs(F.col("size") - gap)
    closing = rest.where((gap > 0) & (off < gap)).groupBy("_pattern").agg(F.min(F.struct(off.alias("_off"), *_place())).alias("_closing"))
    return table.join(F.broadcast(cuts), "_pattern", "left").join(F.broadcast(common.materialise(closing, "mix-closing")), "_pattern", "left")


def _place():
    """The place of a document in the order of its pattern."""
    return [F.col("_order"), F.coalesce(F.lpad(F.col("doc_id").cast("string"), 20, "0"), F.lit("")).alias("_id"), F.col("size"), F.col("_tie")]


def _bucket():
    """The bucket of a document: an equal part of the range of the seeded hash."""
    return F.floor(F.conv(F.substring("_order", 1, 8), 16, 10).cast("double") / F.lit(2.0**32) * F.col("_buckets"))


def _within():
    """Whether a document comes at or before the cut of its pattern."""
    last = F.struct(F.col("_last._order").alias("_order"), F.col("_last._id").alias("_id"), F.col("_last.size").alias("size"), F.col("_last._tie").alias("_tie"))
    return F.when(F.col("_last").isNull(), _bucket() < F.col("_cut_bucket")).otherwise(F.struct(*_place()) <= last)


def take(keyed: DataFrame, planned: DataFrame) -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` (how often the mix takes the document) to keyed documents."""
    out = keyed.drop("source_size", "target", "copies").join(F.broadcast(planned), "_pattern", "left")
    chosen = F.coalesce(_within(), F.lit(False))
    closing = F.col("_closing")
    closes = F.coalesce(closing["_tie"] == F.col("_tie"), F.lit(False))
    copies = F.coalesce("_copies", F.lit(0)) + F.when(F.coalesce(F.col("_rest"), F.lit(0)) > 0, (chosen | closes).cast("long")).otherwise(F.lit(0))
    columns = [c for c in keyed.columns if c not in ("_pattern", "_order", "_tie", "source_size", "target", "copies")]
    return out.select(*columns, "source_size", "target", copies.cast("long").alias("copies"))


def mix(docs: DataFrame, sources=None, seed: str = SEED, text: str = "text", **options) -> DataFrame:
    """Documents with ``size, source_size, target, copies``; the selection is the same in each run."""
    docs = docs.drop("size", "_pattern", "_order", "_tie")
    keyed = common.materialise(_numbered(sized(docs, text, sources, seed)), "mix-documents")
    return take(keyed, plan(keyed.select("_pattern", "_order", "doc_id", "size", "_tie"), **options))


def _numbered(keyed: DataFrame) -> DataFrame:
    """Tell rows of one id and size apart. Any numbers do, as such rows give the same results; they are fixed once written."""
    return keyed.withColumn("_tie", F.monotonically_increasing_id())


def query(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    slim = common.materialise(_numbered(sized(docs).select("_pattern", "_order", "doc_id", "size")), "mix-sizes")
    out = take(slim, plan(slim))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def stage(spark, docs, sf_dir):
    """Each document as often as the mix takes it."""
    docs, columns = common.set_apart(docs, ["size", "source_size", "target", "copies"])
    taken = mix(docs).where("copies > 0")
    return taken.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select(*columns)


#: The same in SQL, for documents of one source each: the flow of a source is then its target.
SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ \\t-\\r]+')), 0)::BIGINT AS size,
    md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')) AS h, coalesce(lpad(doc_id::VARCHAR, 20, '0'), '') AS id FROM documents
),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source
),
level AS (
  SELECT *, 1.5 * (SELECT sum(source_size) FROM s) - coalesce(sum(2 * source_size) OVER before, 0) AS left_over,
    (SELECT sum(w) FROM s) - coalesce(sum(w) OVER before, 0) AS left_w, row_number() OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST) AS k
  FROM s WINDOW before AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
pick AS (SELECT * FROM level WHERE left_over::DOUBLE * w <= 2.0 * source_size * left_w ORDER BY k LIMIT 1),
t AS (
  SELECT source, source_size,
    (CASE WHEN k < coalesce((SELECT k FROM pick), 1000000000) THEN 2.0 * source_size ELSE (SELECT left_over FROM pick)::DOUBLE * w / (SELECT left_w FROM pick)::DOUBLE END)::DOUBLE AS target FROM level
),
f AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS whole,
    CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT % source_size ELSE 0 END AS rest FROM t
),
o AS (
  SELECT d.*, f.source_size, f.target, f.whole, f.rest, sum(size) OVER (PARTITION BY d.source ORDER BY h, id, size ROWS UNBOUNDED PRECEDING) AS reached
  FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source
),
gap AS (SELECT source, rest - coalesce(max(reached) FILTER (reached <= rest), 0) AS gap FROM o WHERE rest > 0 GROUP BY source, rest),
closing AS (
  SELECT o.source, min(struct_pack(off := abs(size - gap), h := h, id := id, size := size)) AS c
  FROM o JOIN gap ON o.source IS NOT DISTINCT FROM gap.source WHERE reached > rest AND gap > 0 AND abs(size - gap) < gap GROUP BY o.source
)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN rest > 0 AND (reached <= rest OR coalesce(c.h = h AND c.id = id AND c.size = size, false)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM o LEFT JOIN closing ON o.source IS NOT DISTINCT FROM closing.source
"""
