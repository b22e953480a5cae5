"""Helpers of the training-data operators: word arrays, shared folders and 64-bit hashes."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that ends a word: space, and tab to carriage return.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = "[ \\t-\\r]+"

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORD_HASH: dict[bytes, int] = {}
_WORD_HASH_LIMIT = 400_000  # entries; beyond it the cache of a Python worker starts anew

U64 = np.uint64
_MULT = U64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the session's checkpoint folder, which all executors share.

    A session without ``spark.checkpoint.dir`` (a local test) gets a temporary one; a cluster sets it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        current = spark.sparkContext.getCheckpointDir()
        if current is None:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
            current = spark.sparkContext.getCheckpointDir()
        base = current
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there, and a lost executor costs no earlier work."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession, batch: int = 16 << 20) -> None:
    """For operators with Python in their tasks: bounded Arrow batches, and this package on the executors.

    Batches are bounded in bytes, so that very long texts don't add up in a Python worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch))
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        file = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
        with zipfile.ZipFile(file, "w") as out:
            for source in sorted(root.rglob("*.py")):
                out.write(source, str(source.relative_to(root.parent)))
        context.addPyFile(str(file))  # Spark's file server hands it to the executors
        _SHIPPED.add(context.applicationId)


def set_apart(docs: DataFrame, names: list[str]) -> tuple[DataFrame, list[Column]]:
    """Rename columns called like ``names``, and give the columns that bring back the frame's own names and order."""
    held = {c: f"_apart_{c}" for c in docs.columns if c in names}
    return docs.withColumnsRenamed(held), [F.col(held.get(c, c)).alias(c) for c in docs.columns]


def word_array(text: Column) -> Column:
    """Words of a text as a native array; a null or blank text has none."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(bare != "", F.split(bare, SPACE_RUN)).otherwise(F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts as 0."""
    return F.coalesce(F.size(word_array(text)), F.lit(0)).cast("long")


def lower_words(text: bytes | None) -> list[bytes]:
    """Words with A-Z in lower case; bytes split at the same white space as ``SPACE``."""
    return text.translate(_LOWER).split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word, the same in every process."""
    cache = _WORD_HASH
    try:
        return np.fromiter(map(cache.__getitem__, words), dtype=U64, count=len(words))
    except KeyError:
        if len(cache) > _WORD_HASH_LIMIT:
            cache.clear()
        for w in set(words):
            if w not in cache:
                cache[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(cache.__getitem__, words), dtype=U64, count=len(words))


def forget() -> None:
    """Gives back this process's cache of word hashes."""
    _WORD_HASH.clear()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values (the splitmix64 finisher)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every run of ``n`` values, by doubling: log2(n) passes instead of n."""
    if len(hashes) < n:
        return np.empty(0, U64)
    done, out, power, width = 0, None, hashes, 1
    base = _MULT
    while True:
        if n & width:
            if out is None:
                out, done = power, width
            else:
                out = out[: len(hashes) - done - width + 1] * _pow(width) + power[done : done + len(hashes) - done - width + 1]
                done += width
        if done == n:
            return mix(out[: len(hashes) - n + 1])
        power = power[: len(power) - width] * (base if width == 1 else _pow(width)) + power[width:]
        width *= 2


def _pow(k: int) -> np.uint64:
    return U64(pow(int(_MULT), k, 1 << 64))


def texts_of(batch, name: str) -> list[bytes | None]:
    """A string column of an Arrow batch as UTF-8 bytes, without decoding."""
    import pyarrow as pa

    column = batch.column(name)
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()
