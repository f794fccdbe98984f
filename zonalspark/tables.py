"""The data model, and how the star tables stand in for its tables.

cell: one row per grid cell and year: zone, region, class, raster_id, bucket,
year, value (null: nodata), area. Lookups and the other tables derive from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.formats import mapped

#: Counted buckets in their order, the composite, and the unclassified.
BUCKETS = ("F", "A", "G", "U")
COMPOSITE = "I"
UNCLASSIFIED = "X"
BUCKET_NAMES = {"F": "Forest", "A": "Agricultural Land", "G": "Grassland", "U": "Urban Areas"}

CELL = "zone INT, region INT, class INT, raster_id INT, bucket STRING, year INT, value DOUBLE, area DOUBLE"
ZONAL = "year INT, zone INT, class INT, n BIGINT, mean DOUBLE, std_pop DOUBLE, min DOUBLE, max DOUBLE"
TREND = "zone INT, class INT, n_years INT, ols_slope DOUBLE, ols_intercept DOUBLE, ols_r2 DOUBLE, ols_pvalue DOUBLE, theilsen_slope DOUBLE, theilsen_intercept DOUBLE, slope_disagreement DOUBLE, flagged BOOLEAN, most_influential_year INT"
HIST = "series STRING, bin INT, bin_left DOUBLE, bin_right DOUBLE, count BIGINT, share DOUBLE"

#: p_type by class id; class 5 counts as forest, class 6 is unclassified.
TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
CLASS_BUCKET = {1: "F", 2: "A", 3: "G", 4: "U", 5: "F", 6: "X"}


def valid(value: Column, nodata: float | None = None) -> Column:
    """value, or null where it is NaN, infinite or nodata."""
    bad = F.isnan(value) | (F.abs(value) == float("inf"))
    if nodata is not None:
        bad = bad | (value == nodata)
    return F.when(~bad, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str, zone: str = "nation", nodata: bool = True) -> DataFrame:
    """Lineitems as cells. zone: nation (25) or supplier. Every seventh line number is nodata."""
    line = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_shipdate")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    class_id = F.array_position(F.array(*map(F.lit, TYPES)), F.col("p_type")).cast("int")
    bucket = mapped(class_id, CLASS_BUCKET)
    value = F.col("l_extendedprice") / 110000.0
    return (
        line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            (F.col("n_nationkey" if zone == "nation" else "s_suppkey") + 1).cast("int").alias("zone"), (F.col("n_regionkey") + 1).alias("region"),
            class_id.alias("class"), F.col("p_size").alias("raster_id"), bucket.alias("bucket"), F.year("l_shipdate").alias("year"),
            (F.when(F.col("l_linenumber") % 7 != 0, value) if nodata else value).alias("value"), F.col("l_quantity").alias("area"),
        )
    )


def cells_sql(zone: str = "nation", nodata: bool = True) -> str:
    """The same as the SQL of a WITH clause."""
    key = "n.n_nationkey" if zone == "nation" else "s.s_suppkey"
    class_id = "CASE p.p_type " + " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(TYPES, 1)) + " END"
    bucket = "CASE p.p_type " + " ".join(f"WHEN '{t}' THEN '{CLASS_BUCKET[i]}'" for i, t in enumerate(TYPES, 1)) + " END"
    value = "l.l_extendedprice / 110000e0"
    return f"""cells AS (SELECT CAST({key} + 1 AS INT) AS zone, CAST(n.n_regionkey + 1 AS INT) AS region, {class_id} AS class, p.p_size AS raster_id, {bucket} AS bucket,
      CAST(year(l.l_shipdate) AS INT) AS year, {f'CASE WHEN l.l_linenumber % 7 <> 0 THEN {value} END' if nodata else value} AS value, l.l_quantity AS area
      FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN part p ON l.l_partkey = p.p_partkey)"""


def grid(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Embeddings as a raster: row = vec_id, col = place in the vector, label = class. spread: vectors are dealt evenly to tasks first."""
    vectors = table(spark, sf_dir, "embeddings")
    return (vectors.hint("rebalance") if spread else vectors).select(F.col("vec_id").cast("int").alias("row"), F.col("label").alias("class"), F.posexplode("embedding").alias("col", "v")).select("row", "col", "class", F.col("v").cast("double").alias("value"))


GRID_SQL = """grid AS (SELECT CAST(vec_id AS INT) AS row, CAST(i - 1 AS INT) AS col, label AS class, CAST(embedding[i] AS DOUBLE) AS value
  FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))"""
