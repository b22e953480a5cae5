"""Queries against their SQL on events that the smallest tables don't have: many in one tile, and some on tile edges."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from test_oracles import rows

from __spark_entry__ import oracle_sql
from cartoloom.plans import QUERIES

TYPES = ("click", "error", "purchase", "signup", "view")


def at(*places):
    """Event ids that user 0 has at these hundredths of a degree from the western end."""
    return [next(i for i in range(36_000) if i * 104_729 % 36_000 == p) for p in places]


def same_as_sql(spark, folder, name, **tables):
    con = duckdb.connect()
    for t, held in tables.items():
        pq.write_table(pa.table(held), f"{folder}/{t}.parquet")
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    got, want = QUERIES[name](spark, str(folder)).toPandas(), con.execute(oracle_sql()[name]).fetch_df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def events(ids, kinds=TYPES):
    ids = list(ids)
    return {"event_id": pa.array(ids, pa.int64()), "user_id": pa.array([0] * len(ids), pa.int64()),
            "event_type": [kinds[k % len(kinds)] for k in range(len(ids))], "value": [k / 4 for k in range(len(ids))]}


def test_points_on_buffered_edges(spark, tmp_path):
    # longitude 5.625 is the right edge of the buffered tile 1/0, and -5.625 the left one of 1/1
    same_as_sql(spark, tmp_path, "t05_pyramid", events=events(at(18_562, 17_437, 1, 35_999)))


def test_layers_of_several_documents(spark, tmp_path):
    same_as_sql(spark, tmp_path, "t24_tiles_to_geojson_index", events=events(range(0, 17 * 36_000 * 21_000, 17 * 36_000), TYPES[:2]))


@pytest.mark.parametrize("name", ["t22_pack_tiles", "t23_unpack_tiles"])
def test_features_are_spread_without_their_layer(spark, name):
    """No row of a feature carries the arrays of its layer, which made a layer's rows grow with the square of its features."""
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    nodes, seen = [plan], 0
    while nodes:
        node = nodes.pop()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
        if node.nodeName() == "Generate" and "[f#" in node.simpleString(10_000):
            kept = node.requiredChildOutput()
            seen += 1
            assert not any("array" in kept.apply(i).dataType().simpleString() for i in range(kept.size()))
    assert seen


@pytest.mark.parametrize("name", ["u02_rasterize_polygons", "u03_rasterize_lines", "r30_feature_raster"])
def test_last_drawn_features_are_found_by_hashing(spark, name):
    """The cells of all features are not sorted to find the last one of each cell."""
    assert "SortAggregate" not in QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
