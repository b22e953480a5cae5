"""Feature tables: select, filter, evaluate, classify, layers (F), description and extent."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geom as g

# Columns of a feature table that are not attributes.
FRAME = ("layer", "layer_ord", "fid", "geom", *g.BOX, "members")


def attribute_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in FRAME]


def feature_id(df):
    return df.select("fid")


def attributes(df, name="attributes"):
    """Id and name -> value map of every row."""
    names = attribute_names(df)
    pairs = [x for n in names for x in (F.lit(n), F.col(n).cast("string"))]
    return df.select("fid", F.create_map(*pairs).alias(name))


def select_fields(df, names=()):
    """Keep the named attributes; no names means all of them."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such field: {missing}")
    keep = names or attribute_names(df)
    return df.select(*[c for c in FRAME if c in df.columns], *keep)


def feature_extent(df):
    """One envelope per feature."""
    return df.select("fid", *[c.alias(n) for n, c in g.bounds("geom").items()])


def extent_filter(df, box):
    """Features whose envelope meets the box, edges included.

    Compares plain columns, so parquet row groups outside the box are skipped.
    """
    if len(box) != 4:
        raise ValueError("a box is [minx, miny, maxx, maxy]")
    return df.where(g.overlaps([F.lit(float(v)) for v in box]))


def geometry_type(df):
    return df.select("fid", F.col("geom.type").alias("geometry_type"), g.type_name("geom.type").alias("type_name"))


def literal(value):
    """Variables are typed: a number equal to its 32-bit integer is an integer."""
    if isinstance(value, float) and value.is_integer() and abs(value) < 2**31:
        return int(value)
    if value is None or isinstance(value, (bool, str, int, float)):
        return value
    raise TypeError(f"variables are booleans, strings or numbers, not {type(value).__name__}")


def evaluate(df, expr, variables=None, name="result"):
    """Value of a SQL expression over the attributes; ``:name`` stands for a variable."""
    args = {k: literal(v) for k, v in (variables or {}).items()}
    return df.sparkSession.sql(f"SELECT *, ({expr}) AS `{name}` FROM {{df}}", args=args, df=df)


def filter_expr(df, expr, variables=None):
    """Rows for which a SQL expression is true."""
    args = {k: literal(v) for k, v in (variables or {}).items()}
    return df.sparkSession.sql(f"SELECT * FROM {{df}} WHERE {expr}", args=args, df=df)


def classify(df, rules, mode="first", otherwise=None, name="rule"):
    """Assign rules, given as ``[(name, sql predicate), ...]`` in order.

    ``first`` takes the first match, ``all`` gives one row per match. Rows that
    match nothing get the ``otherwise`` rule, or are left out without one.
    """
    tests = [(F.lit(n), F.coalesce(F.expr(p), F.lit(False))) for n, p in rules]
    if mode == "first":
        chain = F.lit(otherwise).cast("string")
        for n, p in reversed(tests):
            chain = F.when(p, n).otherwise(chain)
        return df.withColumn(name, chain).where(F.col(name).isNotNull())
    if mode != "all":
        raise ValueError("mode is 'first' or 'all'")
    hits = F.array_compact(F.array(*[F.when(p, n) for n, p in tests]))
    if otherwise is not None:
        hits = F.when(F.size(hits) == 0, F.array(F.lit(otherwise))).otherwise(hits)
    return df.withColumn(name, F.explode(hits))


def visible_layers(layers, scale_denom):
    """Active layers whose scale range holds the denominator."""
    sd = F.lit(float(scale_denom)) if isinstance(scale_denom, (int, float)) else g.col(scale_denom)
    eps = 1e-6
    return layers.where(F.col("active") & (sd >= F.col("min_sd") - eps) & (sd < F.col("max_sd") + eps))


def features_in_scale(df, layers, scale_denom):
    """Features of the layers visible at a scale.

    The layer table has one row per layer of a map; Spark broadcasts it by its
    own size estimate, otherwise the join shuffles.
    """
    return df.join(visible_layers(layers, scale_denom).select("layer"), "layer", "left_semi")


def active_layers(layers):
    return layers.where(F.col("active"))


def queryable_layers(layers):
    return layers.where(F.col("queryable"))


def layer_at(df, key):
    """One layer by name or by 0-based index; an unknown one is an error."""
    if isinstance(key, str):
        found = df.where(F.col("layer") == key)
        if found.limit(1).isEmpty():
            raise ValueError(f"Layer name '{key}' not found")
        return found
    if not isinstance(key, int) or isinstance(key, bool):
        raise TypeError("a layer is named by a string or an index")
    # limit() keeps key + 2 names at most, however many features there are
    first = df.groupBy("layer").agg(F.min("layer_ord").alias("o")).orderBy("o", "layer").limit(max(key, 0) + 1).collect()
    if not 0 <= key < len(first):
        raise ValueError(f"Layer index '{key}' out of range")
    return df.where(F.col("layer") == first[key]["layer"])


def layers(df):
    """Ordered layer names with their feature counts."""
    counts = df.groupBy("layer").agg(F.min("layer_ord").alias("layer_ord"), F.count(F.lit(1)).alias("features"))
    # one row per layer of a map, so a global order is small
    pos = F.row_number().over(Window.orderBy("layer_ord", "layer")) - 1
    return counts.select(pos.cast("int").alias("position"), "layer", "features")


def union_layers(*tables):
    """Append layers in order; attributes missing on one side become null."""
    out = None
    for i, df in enumerate(tables):
        df = df.withColumn("layer_ord", F.lit(i))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def drop_layer(df, name):
    return df.where(F.col("layer") != name)


def field_kind(dtype) -> str:
    if isinstance(dtype, T.NumericType):
        return "Number"
    if isinstance(dtype, T.BooleanType):
        return "Boolean"
    return "String"


def describe(df, encoding="utf-8"):
    """One row per layer and field, with the geometry kind of the layer.

    A layer holding several kinds is a ``collection``; a raster table only has
    its ``nodata`` field.
    """
    if "geom" not in df.columns:
        return df.select(F.lit("raster").alias("type"), F.lit(encoding).alias("encoding"), F.lit("nodata").alias("field"),
                         F.lit("Number").alias("field_type"), F.lit("raster").alias("geometry_type")).distinct()
    kind = (
        F.when(F.col("geom.type").isin(g.POINT, g.MULTIPOINT), "point")
        .when(F.col("geom.type").isin(g.LINE, g.MULTILINE), "linestring")
        .when(F.col("geom.type").isin(g.POLYGON, g.MULTIPOLYGON), "polygon")
        .when(F.col("geom.type") == g.COLLECTION, "collection").otherwise("unknown")
    )
    fields = F.array(*[
        F.struct(F.lit(n).alias("field"), F.lit(field_kind(df.schema[n].dataType)).alias("field_type"))
        for n in attribute_names(df)
    ])
    per_layer = df.groupBy("layer").agg(F.min(kind).alias("lo"), F.max(kind).alias("hi"))
    return per_layer.select(
        "layer", F.lit("vector").alias("type"), F.lit(encoding).alias("encoding"),
        F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise("collection").alias("geometry_type"),
        F.inline(fields),
    )


def extent(df, by=()):
    """Box over all features, in total or per group."""
    aggs = [F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy")]
    return df.groupBy(*by).agg(*aggs)


def feature_count(df, by=()):
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("features"))
