"""Merkle manifest of a dataset: a digest per row, a tree per group, a root over all groups and a proof for every row.

Leaves of a group get a dense rank. A rank is read as octal digits: the lowest digits are grouped away one after the
other inside bounded blocks of ``FAN ** DIGITS`` neighbours, each round nesting the children of a node in its struct, so a
block of leaves becomes one row after one shuffle. The blocks' own digests are ranked already and go through the same
rounds, until one row is left per group; the groups' digests then do the same to the root. On the way back every block row
meets its path in a group of two rows, and transforms and one explode give each child its siblings: proofs need no join.
The one join adds the size of its group to each leaf. No block, row or task grows with the data.

Cases: a null field is hashed as ``-``; rows without a group are one group, the first; rows without an order value come
first in their group and ties are ordered by leaf, so repeated rows have places of their own; a group of one row has its
leaf as its digest; empty tables give no rows. Other columns take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import skew
from . import common

#: Nodes under one parent, and the digits that are grouped away inside a block.
FAN = 8
DIGITS = 3
BLOCK = FAN**DIGITS

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A value with its length before it, or ``-``: neighbouring fields can't run into each other."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, digest, lambda d, step: F.sha2(F.concat(step["left"], d, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.concat_ws("", F.transform(path, lambda step: F.concat(step["left"], step["right"]))), 256)


def levels(n: Column) -> Column:
    """Levels of a tree over ``n`` nodes: none for a single one."""
    return sum(((n > FAN**k).cast("int") for k in range(21)), F.lit(0))


def _roll(nodes: DataFrame) -> DataFrame:
    """One row ``(grp, height, block, node)`` per block of ``nodes(grp, height, pos, node)``; ``node`` has its children inside.

    ``height`` is the number of levels that the group still has; a level above it has one node, which stays as it is.
    """
    rows = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK)).repartition("grp", "block")
    for digit in range(1, DIGITS + 1):
        rows = rows.groupBy("grp", "height", "block", F.floor(F.col("pos") / FAN).alias("pos")).agg(
            F.sort_array(F.collect_list(F.struct("pos", F.col("node.digest").alias("digest"), "node"))).alias("kids")
        )
        kids = F.transform("kids", lambda k: k["node"])
        digest = F.when(F.col("height") >= digit, F.sha2(F.concat_ws("", F.col("kids.digest")), 256)).otherwise(F.col("kids")[0]["digest"])
        rows = rows.select("grp", "height", "block", "pos", F.struct(digest.alias("digest"), kids.alias("kids")).alias("node"))
    return rows.select("grp", "height", "block", "node")


def _step(kids: Column, i: Column) -> Column:
    digests = F.transform(kids, lambda k: k["digest"])
    return F.struct(
        F.concat_ws("", F.slice(digests, F.lit(1), i)).alias("left"),
        F.concat_ws("", F.slice(digests, i + F.lit(2), F.lit(FAN))).alias("right"),
    )


def _spread(blocks: DataFrame) -> DataFrame:
    """``(grp, pos, node, path, top, root)`` for every child of ``blocks(grp, height, block, node, path, top, root)``."""
    found = F.array(F.struct(F.col("node.kids").alias("kids"), F.col("path").alias("path")))

    def below(found, digit, last):
        def child(parent):
            def one(kid, i):
                path = F.when(F.col("height") >= digit, F.concat(F.array(_step(parent["kids"], i)), parent["path"])).otherwise(parent["path"])
                return F.struct((kid if last else kid["kids"]).alias("node" if last else "kids"), path.alias("path"))

            return F.transform(parent["kids"], one)

        return F.flatten(F.transform(found, child))

    for digit in range(DIGITS, 0, -1):
        found = below(found, digit, digit == 1)
    rows = blocks.select("grp", "block", "top", "root", F.posexplode(found).alias("i", "child"))
    return rows.select("grp", (F.col("block") * BLOCK + F.col("i")).alias("pos"), F.col("child.node").alias("node"), F.col("child.path").alias("path"), "top", "root")


def _rounds(nodes: DataFrame, tallest: int, label: str) -> list[DataFrame]:
    """The rolled blocks of every round, from the leaves up to one row per group."""
    rounds = []
    for _ in range(max(1, -(-tallest // DIGITS))):
        rolled = common.materialise(_roll(nodes), label)
        rounds.append(rolled)
        height = F.greatest(F.col("height") - DIGITS, F.lit(0))
        nodes = rolled.select("grp", height.alias("height"), F.col("block").alias("pos"), F.struct("node.digest").alias("node"))
    return rounds


def _down(rounds: list[DataFrame], upper: DataFrame) -> DataFrame:
    """Children of the lowest round with their paths; ``upper(grp, block, path, top, root)`` has those of the top blocks."""
    for k, rolled in enumerate(reversed(rounds)):
        shape = rolled.schema["node"].dataType
        paths = upper.select("grp", "block", F.lit(None).cast("int").alias("height"), F.lit(None).cast(shape).alias("node"), "path", "top", "root")
        bare = rolled.select("grp", "block", "height", "node", F.lit(None).cast(_PATH).alias("path"), F.lit(None).cast("string").alias("top"), F.lit(None).cast("string").alias("root"))
        met = bare.union(paths).groupBy("grp", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("height", "node", "path", "top", "root")])
        out = _spread(met)
        if k + 1 < len(rounds):
            upper = common.materialise(out.select("grp", F.col("pos").alias("block"), "path", "top", "root"), "merkle-paths")
    return out


def manifest(docs: DataFrame, fields: list[str] | None = None, group: str = "lang", order: str = "doc_id", carry: dict[str, Column] | None = None) -> DataFrame:
    """``(key, grp, pos, leaf, path, subroot, root)`` for every row of ``docs``, and the columns of ``carry``.

    ``path`` has the siblings of a row level by level, as two texts of digests: those before it in its run and those after.
    """
    carry = carry or {}
    fields = fields or FIELDS
    kept = F.struct(F.col(order).alias("key"), *[c.alias(f"carry_{k}") for k, c in carry.items()])
    leaves = docs.select(F.col(group).alias("grp"), F.col(order).alias("at"), leaf([F.col(f) for f in fields]).alias("digest"), kept.alias("kept"))
    leaves = common.materialise(leaves, "merkle-leaves")
    sizes = common.materialise(leaves.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "merkle-sizes")
    most, groups = sizes.agg(F.max("n"), F.count(F.lit(1))).first()
    ranked = skew.group_position(leaves, ["grp"], ["at", "digest", "kept"], "pos")
    heights = sizes.select(F.col("grp").alias("grp_"), levels(F.col("n")).alias("height"))
    nodes = ranked.join(heights, F.col("grp").eqNullSafe(F.col("grp_"))).select("grp", "height", "pos", F.struct("digest", "kept").alias("node"))
    rounds = _rounds(nodes, _height(most or 0), "merkle-blocks")
    # the groups' own digests make the last tree
    tops = skew.dense_index(rounds[-1].select("grp", F.col("node.digest").alias("digest")), ["grp"], "pos")
    roots = tops.select(F.lit(0).alias("grp"), F.lit(_height(groups)).alias("height"), "pos", F.struct("digest", F.col("grp").alias("of")).alias("node"))
    above = _rounds(roots, _height(groups), "merkle-roots")
    root = above[-1].select("grp", F.lit(0).cast("long").alias("block"), F.array().cast(_PATH).alias("path"), F.lit(None).cast("string").alias("top"), F.col("node.digest").alias("root"))
    found = _down(above, root)
    upper = found.select(F.col("node.of").alias("grp"), F.lit(0).cast("long").alias("block"), "path", F.col("node.digest").alias("top"), "root")
    out = _down(rounds, common.materialise(upper, "merkle-paths"))
    return out.select(
        F.col("node.kept.key").alias("key"), "grp", "pos", F.col("node.digest").alias("leaf"), "path", F.col("top").alias("subroot"), "root",
        *[F.col(f"node.kept.carry_{k}").alias(k) for k in carry],
    )


def _height(n: int) -> int:
    height = 0
    while FAN**height < n:
        height += 1
    return height


def tampered(docs: DataFrame) -> Column:
    """The leaf after a change of the text: where 3 divides the id's checksum, A-Z become lower case."""
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    return leaf([text if f == "text" else F.col(f) for f in FIELDS])


def query(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    rows = manifest(docs, carry={"forged": tampered(docs)})
    rows = rows.withColumn("folded_root", fold(F.col("forged"), F.col("path")))
    return rows.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _sql() -> str:
    """Levels one by one: nodes of a level, their siblings before and after, and the fold of each leaf through them."""

    def leaf_of(text):
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in ("doc_id::varchar", "source", "lang", "n_chars::varchar", text)) + ")"

    events = "flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))"
    crc = f"xor(list_reduce(list_prepend(4294967295::bigint, {events}), lambda x, e: case when e >= 0 then xor(x, e) else xor(x >> 1, (x & 1) * 3988292384) end), 4294967295)"
    parts = [
        f"bare as (select *, coalesce({crc} % 3 = 0, false) as hit from documents)",
        f"leaves as (select doc_id, lang, {leaf_of('text')} as leaf, {leaf_of(f'(case when hit then translate(text, {chr(39)}{UPPER}{chr(39)}, {chr(39)}{LOWER}{chr(39)}) else text end)')} as forged from bare)",
        "a0 as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf, forged) - 1 as pos, leaf as digest from leaves)",
    ]

    def tree(name, start, group, depth):
        at = start
        for k in range(depth):
            run = f"partition by {group}, pos // 8 order by pos rows between"
            parts.append(
                f"{name}s{k} as (select {group}, pos, digest, count(*) over (partition by {group}) as n,"
                f" coalesce(string_agg(digest, '') over ({run} unbounded preceding and 1 preceding), '') as lhs,"
                f" coalesce(string_agg(digest, '') over ({run} 1 following and unbounded following), '') as rhs from {at})"
            )
            parts.append(f"{name}n{k} as (select {group}, pos // 8 as pos, case when any_value(n) = 1 then any_value(digest) else sha256(string_agg(digest, '' order by pos)) end as digest from {name}s{k} group by {group}, pos // 8)")
            at = f"{name}n{k}"
        return at

    def folds(name, start, group, depth):
        at = start
        for k in range(depth):
            parts.append(
                f"{name}f{k} as (select f.* exclude (folded, proof), case when s.n = 1 then folded else sha256(lhs || folded || rhs) end as folded, proof || lhs || rhs as proof"
                f" from {at} f join {name}s{k} s on f.{group} is not distinct from s.{group} and f.{name}at // {8**k} = s.pos)"
            )
            at = f"{name}f{k}"
        return at

    top = tree("a", "(select lang, pos, digest from a0)", "lang", 6)
    parts.append(f"b0 as (select 0 as one, lang, digest, row_number() over (order by lang nulls first) - 1 as pos from {top})")
    root = tree("b", "(select one, pos, digest from b0)", "one", 3)
    parts.append("c0 as (select a0.doc_id, a0.lang, a0.leaf, a0.pos as aat, b0.pos as bat, 0 as one, b0.digest as subroot, forged as folded, '' as proof from a0 join b0 on a0.lang is not distinct from b0.lang)")
    done = folds("b", folds("a", "c0", "lang", 6), "one", 3)
    return (
        f"with {', '.join(parts)} select doc_id, leaf, subroot, root.digest as root, sha256(proof) as proof_sha256, folded as folded_root, folded = root.digest as verified"
        f" from {done} cross join (select digest from {root}) root"
    )


SQL = _sql()
