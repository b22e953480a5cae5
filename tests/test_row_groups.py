"""Files of packed tiles."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from cartoloom.sources import readers, writers

from test_pack_parts import table


def test_row_groups_of_packed_tiles_are_small(spark, tmp_path, monkeypatch):
    """A reader decodes a row group at once, and a row has up to ``per_row`` features."""
    monkeypatch.setattr(writers, "ROW_GROUP", 2_000, raising=False)
    df = table(spark, 900).withColumn("layer", F.coalesce("layer", F.lit("c"))).withColumn("props", F.coalesce("props", F.create_map(F.lit("k"), F.lit("v"))))
    writers.write_tiles(df, f"{tmp_path}/t", per_row=20)
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{tmp_path}/t/z=1/*.parquet")]
    assert sum(f.num_row_groups for f in files) > 2 * len(files)
    cols = ["z", "x", "y", "layer", "fid", "props", "tgeom"]
    plain = lambda rows: sorted(repr(r.asDict(True)) for r in rows.select(*cols).collect())
    assert plain(readers.read_tiles(spark, f"{tmp_path}/t")) == plain(df)
