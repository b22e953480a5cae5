"""Benchmark decontamination by a generalised suffix automaton over the words of the test items.

The items go into automata of at most ``block_words`` words each (one for any usual benchmark). Documents stream through
an automaton: the state is the longest suffix of the words so far that occurs in an item, its length the matching
length. A matching length of a whole window, or of a whole shorter item, makes its words a hit. The size of an automaton is
bounded by ``block_words`` (an item is not split); those of a longer benchmark follow each other in one stage, so a task holds
one per block in its Python workers.

Cases: a null or empty text has no words and no hits; an item without words never occurs; repeated items count once per
``item_id``; a null ``item_id`` is listed as the empty string; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

WINDOW = 10
BLOCK_WORDS = 2_000_000
#: A-Z in lower case; bytes of words (0-9, a-z and all of non-ASCII) stay, others become a space.
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TO_WORDS).split() if text else []


class Automaton:
    """Suffix automaton of several word sequences, with what each state says about windows.

    ``items_at[s]``: items with the window that state ``s`` (or its suffix of window length) stands for.
    ``short_at[s]``: (length, item) of whole short items that end in ``s`` or in one of its suffixes.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.following: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            if ids:
                coded.append((name, ids))
                last = 0
                for x in ids:
                    last = self._extend(last, x)
        self._describe(coded)
        self.shortest = min([window, *(len(ids) for _, ids in coded)])

    def _extend(self, last: int, x: int) -> int:
        following, link, length = self.following, self.link, self.length
        known = following[last].get(x)
        if known is not None:
            return known if length[known] == length[last] + 1 else self._split(last, x, known)
        new = self._state({}, length[last] + 1)
        at = last
        while at != -1 and x not in following[at]:
            following[at][x] = new
            at = link[at]
        if at == -1:
            link[new] = 0
        else:
            known = following[at][x]
            link[new] = known if length[known] == length[at] + 1 else self._split(at, x, known)
        return new

    def _state(self, following: dict[int, int], length: int) -> int:
        self.following.append(following)
        self.link.append(0)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, at: int, x: int, known: int) -> int:
        twin = self._state(dict(self.following[known]), self.length[at] + 1)
        self.link[twin] = self.link[known]
        self.link[known] = twin
        while at != -1 and self.following[at].get(x) == known:
            self.following[at][x] = twin
            at = self.link[at]
        return twin

    def _describe(self, coded: list[tuple[str, list[int]]]) -> None:
        window, link, length = self.window, self.link, self.length
        order = sorted(range(len(link)), key=length.__getitem__)
        anchor = [-1] * len(link)  # the suffix state that holds the length of a window
        for s in order[1:]:
            anchor[s] = anchor[link[s]] if length[link[s]] >= window else (s if length[s] >= window else -1)
        held: dict[int, set[str]] = {}
        ends: dict[int, set[tuple[int, str]]] = {}
        for name, ids in coded:
            state = 0
            for n, x in enumerate(ids, 1):
                state = self.following[state][x]
                if n >= window:
                    held.setdefault(anchor[state], set()).add(name)
            if len(ids) < window:
                ends.setdefault(state, set()).add((len(ids), name))
        self.items_at = [held.get(a) if a >= 0 else None for a in anchor]
        self.short_at: list[set[tuple[int, str]] | None] = [None] * len(link)
        for s in order[1:]:
            above, own = self.short_at[link[s]], ends.get(s)
            self.short_at[s] = above | own if above and own else above or own

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans [start, end) that windows hit, merged, and the items that they belong to."""
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
        # words of no item set the state back to the start: only runs of known words can hold a window
        cuts = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).astype(np.int8)))
        starts, ends = cuts[::2], cuts[1::2]
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        for i in np.flatnonzero(ends - starts >= self.shortest):
            self._walk(ids[starts[i] : ends[i]].tolist(), int(starts[i]), spans, found)
        return spans, found

    def _walk(self, ids: list[int], place: int, spans: list[tuple[int, int]], found: set[str]) -> None:
        following, link, length, window = self.following, self.link, self.length, self.window
        items_at, short_at, shortest = self.items_at, self.short_at, self.shortest
        state = matched = 0
        for x in ids:
            place += 1
            while x not in following[state]:
                state = link[state]
                if state == -1:
                    state = matched = 0
                    break
                matched = length[state]
            else:
                state = following[state][x]
                matched += 1
            if matched < shortest:
                continue
            reach = 0
            if matched >= window:
                reach = window
                found |= items_at[state]
            for size, name in short_at[state] or ():
                if size <= matched:
                    reach = max(reach, size)
                    found.add(name)
            if reach:
                start = place - reach
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, place))


def _blocks(benchmark: DataFrame, block_words: int, text: str, item_id: str) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in blocks of bounded size; the driver holds one block at a time."""
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"), F.col(text).cast("binary").alias("text")).where("text IS NOT NULL")
    block, held = [], 0
    for row in rows.toLocalIterator():
        words = words_of(bytes(row["text"]))
        if not words:
            continue
        if block and held + len(words) > block_words:
            yield block
            block, held = [], 0
        block.append((row["name"], words))
        held += len(words)
    if block:
        yield block


def find(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, text: str = "text", item_text: str = "text", item_id: str = "item_id"
) -> DataFrame:
    """Add ``n_words``, ``spans`` (hit word ranges) and ``items`` (sorted ids of the items found) to each document."""
    spark = docs.sparkSession
    common.prepare(spark)
    made = ["n_words", "spans", "items"]
    out = docs.drop(*made)
    schema = T.StructType(
        [*out.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("items", T.ArrayType(T.StringType()))]
    )
    nothing = out.withColumns({"n_words": F.lit(0).cast("long"), "spans": F.array().cast("array<array<bigint>>"), "items": F.array().cast("array<string>")})
    first = True
    for block in _blocks(benchmark, block_words, item_text, item_id):
        out = (out if first else out.select(*schema.names)).mapInArrow(_scanner(spark.sparkContext.broadcast(Automaton(block, window)), text, not first), schema)
        first = False
    if first:
        out = nothing.mapInArrow(_scanner(spark.sparkContext.broadcast(Automaton([], window)), text, True), schema)
    return out


def _scanner(automaton, text: str, more: bool):
    """``more``: the batch has spans and items of earlier blocks, to which these are added."""

    def scan(batches):
        import pyarrow as pa

        for batch in batches:
            counts, spans, items = [], [], []
            earlier = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist()) if more else None
            for value in common.texts_of(batch, text):
                words = words_of(value)
                hit, found = automaton.value.scan(words)
                if earlier is not None:
                    old_hit, old_found = next(earlier)
                    hit, found = merged([*map(tuple, old_hit), *hit]), found | set(old_found)
                counts.append(len(words))
                spans.append([list(x) for x in hit])
                items.append(sorted(found))
            kept = [n for n in batch.schema.names if n not in ("n_words", "spans", "items")]
            arrays = [batch.column(n) for n in kept] + [pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "n_words", "spans", "items"])

    return scan


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and out[-1][1] >= start:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def n_hit(spans):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + F.get(s, F.lit(1)) - F.get(s, F.lit(0)))


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.5, text: str = "text", **options) -> DataFrame:
    """Cut the hit spans out of the texts; documents of which over ``max_coverage`` is hit go. Other columns stay."""
    docs, columns = common.set_apart(docs, ["n_words", "spans", "items"])
    found = find(docs, benchmark, window, text=text, **options)
    found = found.where(n_hit(F.col("spans")) <= F.col("n_words") * F.lit(max_coverage))
    hit = F.when(F.size("spans") > 0, F.col(text))  # other texts don't go to Python again
    cutter = F.udf(lambda value, spans: None if value is None else cut(value, spans), "string", useArrow=True)
    clean = F.when(F.size("spans") == 0, F.col(text)).otherwise(cutter(hit, F.col("spans")))
    return found.withColumn(text, clean).select(*columns)


def cut(value: str, spans: list[list[int]]) -> str:
    """The text without the words of the spans and what lies between them."""
    import re

    places = [m.span() for m in re.finditer("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", value)]
    out, at = [], 0
    for start, end in spans:
        out.append(value[at : places[start][0]])
        at = places[end - 1][1]
    return "".join([*out, value[at:]])


def query(spark, sf_dir):
    found = find(common.table(spark, sf_dir, "documents").select("doc_id", "text"), common.table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def stage(spark, docs, sf_dir):
    """Passages of test items are cut out; a document that is mostly test items goes."""
    columns = docs.columns
    clean = remove(docs, common.table(spark, sf_dir, "benchmark"))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def brute_force(texts: list[str | None], items: list[tuple[str, str | None]], window: int = WINDOW):
    """(n_words, n_hit, sorted item names) of each text, by looking at every window of every item."""
    out = []
    coded = [(n, words_of((t or "").encode())) for n, t in items]
    for text in texts:
        words, hit, names = words_of((text or "").encode()), set(), set()
        for name, item in coded:
            k = min(window, len(item))
            grams = {tuple(item[i : i + k]) for i in range(len(item) - k + 1)} if k else set()
            for i in range(len(words) - k + 1 if k else 0):
                if tuple(words[i : i + k]) in grams:
                    hit.update(range(i, i + k))
                    names.add(name)
        out.append((len(words), len(hit), sorted(names)))
    return out


def sha256_of(names: list[str]) -> str:
    return hashlib.sha256(",".join(names).encode()).hexdigest()


SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS name,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM benchmark
),
window_of AS (
  SELECT DISTINCT name, k, array_to_string(words[i : i + k - 1], ' ') AS w
  FROM (SELECT name, words, least({WINDOW}, len(words)) AS k, unnest(generate_series(1, len(words) - least({WINDOW}, len(words)) + 1)) AS i FROM b WHERE len(words) > 0)
),
sizes AS (SELECT DISTINCT k FROM window_of),
place AS (
  SELECT row_id, k, i, array_to_string(words[i : i + k - 1], ' ') AS w
  FROM (SELECT row_id, words, k, unnest(generate_series(1, len(words) - k + 1)) AS i FROM d, sizes WHERE len(words) >= k)
),
hit AS (SELECT DISTINCT row_id, p.k, i, name FROM place p JOIN window_of o ON p.k = o.k AND p.w = o.w),
hit_word AS (SELECT DISTINCT row_id, unnest(generate_series(i, i + k - 1)) AS at FROM hit),
n AS (SELECT row_id, count(*) AS n_hit FROM hit_word GROUP BY row_id),
names AS (SELECT row_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS list FROM (SELECT DISTINCT row_id, name FROM hit) GROUP BY row_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (row_id) LEFT JOIN names USING (row_id)
"""
