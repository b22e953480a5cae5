"""Token ids as flat unsigned integer files with 64-bit document offsets.

``write_tokens`` range-partitions documents by ``doc_id`` and writes three flat little-endian files per partition:

* ``part-N.tokens``: the ids, 16 bits each when the vocabulary fits, else 32;
* ``part-N.offsets``: 64-bit offsets of the documents in the part, one more than there are documents;
* ``part-N.docs``: 64-bit document ids.

``manifest`` (Parquet, one row per part) has the counts and the prefix sums: the number of ids and documents before the
part. A task writes under a name of its own attempt and renames at its end, so a repeated task replaces the same files.

Cases: a null or empty text is the end id alone; null ids come first (their number is in the manifest); repeated ids stay
next to each other, ordered by text; other columns play no part.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

END_ID = 2
#: Entries of each of the two generations of a Python worker's word cache, and of its cache of pieces.
CACHE_WORDS = 200_000
CACHE_PIECES = 300_000
#: Bytes of an Arrow batch: the buffers of a batch, its texts and their ids are in memory beside the caches.
BATCH = 4 << 20

# The pre-tokenizer's pattern that ``PieceEncoder`` knows, and the same for ASCII and Latin letters.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \t-\ra-zß-öø-ÿ0-9]+")
LATIN = re.compile(r"[\x00-\x7fÀ-ÖØ-öø-ÿ]*")

_CACHE: dict[str, tuple] = {}


class WordEncoder:
    """Encodes texts word by word with the tokenizers library, each distinct word once while it is in the cache.

    Right for tokenizers whose tokens never cross white space and that drop it; ``fits`` tests for that.
    """

    def __init__(self, tokenizer_json: str, dtype: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.dtype = dtype
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def encode(self, text: bytes | None) -> bytes:
        """The ids of a text as flat bytes."""
        words = text.split() if text else []
        try:
            return b"".join(map(self.young.__getitem__, words))
        except KeyError:
            self._learn(set(words))
            return b"".join(map(self.young.__getitem__, words))

    def _learn(self, words: set[bytes]) -> None:
        if len(self.young) > CACHE_WORDS:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new = []
        for w in words:
            if w not in young:
                if w in old:
                    young[w] = old[w]
                else:
                    new.append(w)
        young.update(zip(new, self._encoded(new)))

    def _encoded(self, words: list[bytes]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch([w.decode() for w in words], add_special_tokens=False) if words else []
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in encoded]


class PieceEncoder(WordEncoder):
    """Splits texts into the pre-tokenizer's pieces and encodes each distinct piece once while it is in the cache.

    For tokenizers that lower-case and split by ``SPLIT_PATTERN``: a text's ids are those of its pieces. Texts with other
    than ASCII characters and Latin letters, or with special tokens, go word by word.
    """

    def __init__(self, tokenizer_json: str, dtype: str):
        import json

        super().__init__(tokenizer_json, dtype)
        self.special = re.compile("|".join(re.escape(t["content"]) for t in json.loads(tokenizer_json).get("added_tokens", [])) or "(?!)")
        self.pieces: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}

    def encode(self, text: bytes | None) -> bytes:
        plain = (text or b"").decode()
        if not LATIN.fullmatch(plain) or self.special.search(plain):
            return super().encode(text)
        pieces = PIECES.findall(plain.lower())
        try:
            return b"".join(map(self.pieces.__getitem__, pieces))
        except KeyError:
            self._learn_pieces(set(pieces))
            return b"".join(map(self.pieces.__getitem__, pieces))

    def _learn_pieces(self, pieces: set[str]) -> None:
        if len(self.pieces) > CACHE_PIECES:
            self.old_pieces, self.pieces = self.pieces, {}
        known, old = self.pieces, self.old_pieces
        new = []
        for p in pieces.difference(known):
            if p in old:
                known[p] = old[p]
            else:
                new.append(p)
        known.update(zip(new, self._encoded([p.encode() for p in new])))


class TextEncoder:
    """Encodes whole texts, for tokenizers of any other kind."""

    def __init__(self, tokenizer_json: str, dtype: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.dtype = dtype

    def encode(self, text: bytes | None) -> bytes:
        return np.array(self.tokenizer.encode((text or b"").decode(), add_special_tokens=False).ids, dtype=self.dtype).tobytes()


def fits(tokenizer_json: str) -> bool:
    """Whether words can be encoded one by one: the pre-tokenizer drops white space and nothing spans it."""
    import json

    spec = json.loads(tokenizer_json)
    before = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [spec.get("pre_tokenizer")])
    drops = any(p and p.get("type") == "Split" and p.get("behavior") == "Removed" and p.get("invert") and "[^\\s" in (p.get("pattern") or {}).get("Regex", "") for p in before)
    prefix = any(p and p.get("add_prefix_space") for p in before)
    plain = all(not (t.get("lstrip") or t.get("rstrip") or t.get("single_word") or set(t["content"]) & set(" \t\n\r\x0b\x0c")) for t in spec.get("added_tokens", []))
    return drops and plain and not prefix and not spec.get("post_processor")


def by_pieces(tokenizer_json: str) -> bool:
    """Whether the tokenizer lower-cases, composes and splits the way ``PieceEncoder`` does."""
    import json

    spec = json.loads(tokenizer_json)
    before = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    patterns = [p.get("pattern", {}).get("Regex") for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", []) if p.get("type") == "Split"]
    return fits(tokenizer_json) and before == ["NFC", "Replace", "Lowercase"] and patterns == [SPLIT_PATTERN]


def _encoder(tokenizer_json: str, dtype: str):
    """One encoder for each Python worker, kept between tasks."""
    held = _CACHE.get("encoder")
    if held is None or held[0] != (tokenizer_json, dtype):
        kind = PieceEncoder if by_pieces(tokenizer_json) else WordEncoder if fits(tokenizer_json) else TextEncoder
        common.forget()  # Spark goes on with the Python workers of earlier stages
        held = _CACHE["encoder"] = ((tokenizer_json, dtype), kind(tokenizer_json, dtype))
    return held[1]


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID, text: str = "text", doc_id: str = "doc_id") -> None:
    """Encode all documents into files under ``folder``, which every executor must reach."""
    import json

    spark = docs.sparkSession
    common.prepare(spark, BATCH)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    data = json.loads(spec)
    top = max([end_id, *(t["id"] for t in data.get("added_tokens", [])), *data["model"]["vocab"].values()])
    dtype = "<u2" if top < 1 << 16 else "<u4"
    sent = spark.sparkContext.broadcast(spec)  # the tokenizer's file: of fixed size
    end = np.array([end_id], dtype=dtype).tobytes()
    width = len(end)

    def write(batches):
        import os

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        files, root = _file_system(folder)
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        files.create_dir(root, recursive=True)
        tokens = None
        sizes, ids, nulls = [], [], 0
        for batch in batches:
            if tokens is None:
                encoder = _encoder(sent.value, dtype)
                tokens = files.open_output_stream(f"{root}/part-{part}.tokens.{attempt}")
            for key, value in zip(batch.column("id").to_pylist(), common.texts_of(batch, "text")):
                coded = encoder.encode(value) + end
                tokens.write(coded)
                sizes.append(len(coded) // width)
                nulls += key is None
                ids.append(0 if key is None else key)
        if tokens is None:
            return
        tokens.close()
        offsets = np.concatenate(([0], np.cumsum(np.array(sizes, dtype=np.int64))))
        for name, values in (("offsets", offsets.astype("<i8")), ("docs", np.array(ids, dtype="<i8"))):
            with files.open_output_stream(f"{root}/part-{part}.{name}.{attempt}") as out:
                out.write(values.tobytes())
        for name in ("tokens", "offsets", "docs"):
            done = f"{root}/part-{part}.{name}"
            if files.get_file_info(done).type.name == "File":
                files.delete_file(done)
            files.move(f"{done}.{attempt}", done)
        yield pa.RecordBatch.from_pydict({"part": [part], "n_docs": [len(ids)], "n_tokens": [int(offsets[-1])], "n_null_ids": [nulls], "id_bits": [8 * width]})

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions(F.asc_nulls_first("id"), F.xxhash64("text"), "text")
    parts = ordered.mapInArrow(write, "part long, n_docs long, n_tokens long, n_null_ids long, id_bits long")
    parts = common.materialise(parts, "token-parts")  # the files are written once, here
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    bases = parts.withColumns({"token_base": F.coalesce(F.sum("n_tokens").over(before), F.lit(0)), "doc_base": F.coalesce(F.sum("n_docs").over(before), F.lit(0))})
    bases.write.mode("overwrite").parquet(f"{folder}/manifest")


def read_tokens(spark: SparkSession, folder: str, digest_only: bool = True) -> DataFrame:
    """One row per document in file order: ``doc_id, start, n_tokens, ids_crc32``, and ``ids`` unless ``digest_only``."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    n_parts = max(1, manifest.count())

    def read(batches):
        import pyarrow as pa

        files, root = _file_system(folder)

        def flat(part, name, dtype):
            path = f"{root}/part-{part}.{name}"
            if files.type_name == "local":
                return np.frombuffer(pa.memory_map(path).read_buffer(), dtype=dtype)
            with files.open_input_file(path) as source:
                return np.frombuffer(source.read_buffer(), dtype=dtype)

        for batch in batches:
            for row in batch.to_pylist():
                offsets = flat(row["part"], "offsets", "<i8")
                keys = flat(row["part"], "docs", "<i8").tolist()
                tokens = flat(row["part"], "tokens", f"<u{row['id_bits'] // 8}")
                for low in range(0, len(keys), 2_000):
                    high = min(low + 2_000, len(keys))
                    marks = offsets[low : high + 1].tolist()
                    spans = [tokens[a:b].astype("<u4") for a, b in zip(marks, marks[1:])]
                    out = {
                        "doc_id": pa.array([None if i < row["n_null_ids"] else keys[i] for i in range(low, high)], pa.int64()),
                        "start": pa.array([row["token_base"] + a for a in marks[:-1]], pa.int64()),
                        "n_tokens": pa.array([len(s) for s in spans], pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(s.tobytes()) for s in spans], pa.int64()),
                    }
                    if not digest_only:
                        out["ids"] = pa.array([s.astype("<i8") for s in spans], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ("" if digest_only else ", ids array<long>")
    return manifest.repartitionByRange(n_parts, "part").mapInArrow(read, schema)


def _written(spark, docs, tokenizer_path=None):
    import public_tokenizers

    folder = common.shared_folder(spark, "tokens")
    write_tokens(docs, folder, tokenizer_path or public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, folder)


def query(spark, sf_dir):
    return _written(spark, common.table(spark, sf_dir, "documents"))


def stage(spark, docs, sf_dir):
    """The documents as token files; returns one row per document with its place in them."""
    return _written(spark, docs)
