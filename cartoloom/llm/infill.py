"""Fill-in-the-middle: documents become prefix, suffix and middle behind sentinels, and can be restored from that.

A text of n code points is cut at two places drawn from a digest of its id. Tasks emit it as pieces of at most ``CHUNK``
code points, keyed by row and place in the output. One shuffle by row and a sort by (row, place) bring the pieces of an
output together in order; they are streamed into a running digest, so a task holds one piece at a time, however long a
document is. For restoration the stream is read from the output alone: a piece that opens with a sentinel begins a part, and
the parts' own order is the next sort key. That sort stays inside the partition and needs no second shuffle.

A row is keyed by its place in the scan, not its id, so repeated rows stay rows of their own and a hot id is spread.

Cases: a null or empty text is plain and has no units; a text that holds a sentinel is plain; a null id draws its places
from an empty id; other columns take no part.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

CHUNK = 8_192
SEED = "1:"
PLAIN_FROM = 90
SPM_BELOW = 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Parts in the order of the output; a part is named by its place in the text.
ORDERS = {"psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}

_FLUSH = 4 << 20  # bytes of pieces in one Arrow batch
_META = "doc_id long, n long, form string, cut long, stop long"
_PIECES = f"row long, place long, piece binary, {_META}"


def plans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(row, text, doc_id, n, form, cut, stop)``: the two cuts and the form of every document, in column functions."""
    key = F.col(doc_id).cast("long")
    rows = docs.select(key.alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.sha2(F.concat(F.lit(SEED), F.coalesce(key.cast("string"), F.lit(""))), 256).alias("h"))
    rows = rows.withColumns({f"h{k}": F.conv(F.substring("h", 8 * k - 7, 8), 16, 10).cast("long") for k in (1, 2, 3, 4)} | {"n": F.length("text").cast("long")})
    one, two = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    held = F.lit(False)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        held = held | F.contains(F.col("text"), F.lit(sentinel))
    form = F.when((F.col("n") == 0) | held | (F.col("h3") % 100 >= PLAIN_FROM), "plain").when(F.col("h4") % 100 < SPM_BELOW, "spm").otherwise("psm")
    return rows.select(F.monotonically_increasing_id().alias("row"), "text", "doc_id", "n", form.alias("form"), F.least(one, two).alias("cut"), F.greatest(one, two).alias("stop"))


def _parts(text: str, form: str, cut: int, stop: int):
    """``(sentinel, begin, end)`` of every part of the output."""
    if form == "plain":
        return (("", 0, len(text)),)
    ends = ((0, cut), (cut, stop), (stop, len(text)))
    return tuple((sentinel, *ends[part]) for sentinel, part in ORDERS[form])


def _cut(chunk: int):
    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("row", pa.int64()), ("place", pa.int64()), ("piece", pa.binary()), ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("cut", pa.int64()), ("stop", pa.int64())])
        for batch in batches:
            out, held = [], 0
            for r in batch.to_pylist():
                meta = (r["doc_id"], r["n"], r["form"], r["cut"], r["stop"])
                text, place = r["text"], 0
                for sentinel, begin, end in _parts(text, r["form"], r["cut"], r["stop"]):
                    for at in range(begin, max(end, begin + 1), chunk):
                        piece = ((sentinel if at == begin else "") + text[at : min(at + chunk, end)]).encode()
                        # what holds for the whole document goes with its first piece
                        out.append((r["row"], place, piece, *(meta if place == 0 else (None,) * 5)))
                        place += 1
                        held += len(piece) + 64
                        if held > _FLUSH:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                            out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return run


def pieces(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", chunk: int = CHUNK) -> DataFrame:
    """The outputs as pieces ``(row, place, piece)`` in order within each partition; all pieces of a row are in one.

    The first piece of a row also has ``doc_id, n, form, cut, stop``.
    """
    common.prepare(docs.sparkSession)
    cut = plans(docs, text, doc_id).mapInArrow(_cut(chunk), _PIECES)
    return cut.repartition("row").sortWithinPartitions("row", "place")


def _stream(batches):
    """Rows of sorted pieces as tuples, batch by batch."""
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("row", "place", "piece", "doc_id", "n", "form", "cut", "stop")))


def _joined(batches):
    import pyarrow as pa

    names = ["doc_id", "form", "text"]
    types = [pa.int64(), pa.string(), pa.string()]
    row, meta, own, out, held = None, None, [], [], 0

    def packed():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    for at, _, piece, doc_id, _, form, _, _ in _stream(batches):
        if at != row:
            if row is not None:
                out.append((*meta, b"".join(own).decode()))
            row, meta, own = at, (doc_id, form), []
        own.append(piece)
        held += len(piece)
        if held > _FLUSH and out:
            yield packed()
            out, held = [], 0
    if row is not None:
        out.append((*meta, b"".join(own).decode()))
        yield packed()


def texts(assembled: DataFrame) -> DataFrame:
    """``(doc_id, form, text)``: the output of every document, from ``pieces``."""
    return assembled.mapInArrow(_joined, "doc_id long, form string, text string")


def _digest(batches):
    """Pieces of the outputs to pieces of the texts: ``part`` and ``place`` order them, part -1 has the output's digest."""
    import pyarrow as pa

    schema = pa.schema([("row", pa.int64()), ("part", pa.int32()), ("place", pa.int64()), ("piece", pa.binary()), ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("cut", pa.int64()), ("stop", pa.int64()), ("digest", pa.string())])
    none = (None,) * 6
    row, meta, running, part, opens, out, held = None, None, None, 0, (), [], 0

    def packed():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    for at, place, piece, *own in _stream(batches):
        if at != row:
            if row is not None:
                out.append((row, -1, 0, None, *meta, running.hexdigest()))
            row, meta, running, part = at, own, hashlib.sha256(), 0
            opens = [(s.encode(), p) for s, p in ORDERS.get(meta[2], ())]
        running.update(piece)
        for sentinel, named in opens:
            if piece.startswith(sentinel):
                piece, part = piece[len(sentinel) :], named
                break
        out.append((row, part, place, piece, *none))
        held += len(piece) + 64
        if held > _FLUSH:
            yield packed()
            out, held = [], 0
    if row is not None:
        out.append((row, -1, 0, None, *meta, running.hexdigest()))
        yield packed()


def _restored(batches):
    import pyarrow as pa

    names = ["doc_id", "n", "form", "cut", "stop", "output_sha256", "restored_sha256"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    row, meta, running = None, None, None
    for batch in batches:
        out = []
        for at, part, piece, *own in zip(*(batch.column(c).to_pylist() for c in ("row", "part", "piece", "doc_id", "n", "form", "cut", "stop", "digest"))):
            if at != row:
                if row is not None:
                    out.append((*meta, running.hexdigest()))
                row, meta, running = at, own, hashlib.sha256()
            if part >= 0:
                running.update(piece)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
    if row is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*meta, running.hexdigest()), types)], names=names)


def restore(assembled: DataFrame) -> DataFrame:
    """One row per document: its cuts, the digest of its output and that of the text rebuilt from the output."""
    rekeyed = assembled.mapInArrow(_digest, f"row long, part int, place long, piece binary, {_META}, digest string")
    ordered = rekeyed.sortWithinPartitions("row", "part", "place")
    return ordered.mapInArrow(_restored, f"{_META}, output_sha256 string, restored_sha256 string")


def query(spark, sf_dir):
    rows = restore(pieces(common.table(spark, sf_dir, "documents")))
    cut = F.col("form") != "plain"
    return rows.select(
        "doc_id", "n", "form", F.when(cut, F.col("cut")).alias("prefix_chars"), F.when(cut, F.col("stop") - F.col("cut")).alias("middle_chars"),
        "output_sha256", "restored_sha256",
    )


SQL = """
with a as (select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n, sha256(concat('1:', doc_id)) as h from documents),
b as (select *, ('0x' || h[1:8])::ubigint as h1, ('0x' || h[9:16])::ubigint as h2, ('0x' || h[17:24])::ubigint as h3, ('0x' || h[25:32])::ubigint as h4 from a),
c as (select *, least(h1 % (n + 1), h2 % (n + 1))::bigint as cut, greatest(h1 % (n + 1), h2 % (n + 1))::bigint as stop,
  case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from b),
d as (select *, substring(t, 1, cut) as p, substring(t, cut + 1, stop - cut) as m, substring(t, stop + 1, n - stop) as s from c)
select doc_id, n, form, case when form <> 'plain' then cut end as prefix_chars, case when form <> 'plain' then stop - cut end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from d
"""
