"""Readers and writers: extracts, feature documents, partitioned datasets, reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limes.functions.names import level_label
from limes.functions.numbers import list_digest
from limes.operators.geometry import dissolve
from limes.operators.index import with_offsets
from limes.operators.rings import outlines
from limes.session import raised_if_empty

FEATURE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("osm_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("parent", T.StringType()),
        T.StructField("names", T.MapType(T.StringType(), T.StringType())),
    ]
)
DOCUMENT = T.StructType([T.StructField("country", T.StringType()), T.StructField("admin_by_level", T.MapType(T.StringType(), T.ArrayType(FEATURE)))])


def require_extracts(found: DataFrame, expected: list[str]) -> None:
    """An error that names every expected extract which is not there."""
    spark = found.sparkSession
    wanted = spark.createDataFrame([(e,) for e in expected], "extract string")
    missing = [r[0] for r in wanted.join(found.select("extract").distinct(), "extract", "left_anti").orderBy("extract").collect()]
    if missing:
        raise FileNotFoundError("extracts are missing: " + ", ".join(missing))


def read_elements(spark: SparkSession, path: str, expected: list[str]) -> DataFrame:
    """A table partitioned by ``extract``, with the extracts' rank in the configured order."""
    rows = spark.read.parquet(path)
    require_extracts(rows, expected)
    rank = F.create_map(*(F.lit(x) for i, e in enumerate(expected) for x in (e, i)))
    return rows.withColumn("extract", F.col("extract").cast("string")).withColumn("extract_ord", F.try_element_at(rank, F.col("extract"))).filter("extract_ord IS NOT NULL")


def latest_of_stems(listing: DataFrame, stems: list[str]) -> DataFrame:
    """``stem, name``: for each stem the last file name that begins with it."""
    wanted = F.explode(F.array(*(F.lit(s) for s in stems)))
    return listing.select("name", wanted.alias("stem")).filter(F.startswith("name", "stem")).groupBy("stem").agg(F.max("name").alias("name"))


def country_boundary(polygons: DataFrame, iso: Column | str | None = None, name: Column | str | None = None) -> DataFrame:
    """Country polygons by code or name; all of them without either; reading the result is an error if none is left."""
    if iso is None and name is None:
        return polygons
    hit = F.lit(False)
    for column, value in (("iso", iso), ("name", name)):
        if value is not None:
            hit = hit | F.coalesce(F.col(column) == value, F.lit(False))
    kept = polygons.filter(hit).distinct()
    return kept.unionByName(raised_if_empty(kept, "no country polygon matches"))


def country_outline(edges: DataFrame, country: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dissolved rings of the features ``id`` that ``country_boundary`` kept, and their box."""
    own = edges.join(country.select(F.col("id").alias("feature_id")), "feature_id", "left_semi").withColumn("country", F.lit("country"))
    segments = dissolve(own, "country")
    low = lambda a, b: F.min(F.least(a, b))
    high = lambda a, b: F.max(F.greatest(a, b))
    box = segments.groupBy("country").agg(low("x1", "x2").alias("minx"), low("y1", "y2").alias("miny"), high("x1", "x2").alias("maxx"), high("y1", "y2").alias("maxy"))
    return outlines(segments, "country"), box


def documents_of(features: DataFrame) -> DataFrame:
    """One document a country: features by level in order of id."""
    one = F.struct("id", "osm_id", "name", "level", "parent", "names")
    level = features.groupBy("country", "level").agg(F.array_sort(F.collect_list(one), lambda a, b: F.when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0)).alias("rows"))
    return level.groupBy("country").agg(F.map_from_entries(F.collect_list(F.struct(F.col("level").cast("string"), "rows"))).alias("admin_by_level"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Features of JSON documents by ascending level and place in their list."""
    docs = spark.read.schema(DOCUMENT).json(path)
    rows = docs.select("country", F.explode("admin_by_level").alias("key", "rows")).select("country", F.col("key").cast("int").alias("at_level"), F.posexplode("rows").alias("pos", "f"))
    return rows.select("country", "at_level", "pos", "f.*")


def write_dataset(features: DataFrame, path: str, by: list[str]) -> None:
    """Idempotent by partition: rewriting a country replaces that country only."""
    features.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def dataset_rows(features: DataFrame, boxes: DataFrame, labels: dict[int, str] | None = None) -> DataFrame:
    """Features ``id, level, name, parent_id, names`` as a dataset has them: with box, label, and names only where there are any."""
    box = boxes.groupBy(F.col("feature_id").alias("id")).agg(F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))
    row = features.join(box, "id", "left").withColumn("bbox", F.when(F.col("minx").isNotNull(), F.array(*(F.col(c).cast("double") for c in ("minx", "miny", "maxx", "maxy")))))
    return row.select("id", F.col("id").alias("osm_id"), "level", level_label(F.col("level"), labels).alias("label"), "name", F.when(F.size("names") > 0, F.col("names")).alias("names"), "bbox", F.col("parent_id").alias("parent"))


def staged(spark: SparkSession, folder: str, key: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The stage's table under ``key``: read if it is there and complete, else made and written."""
    path = f"{folder}/stage={key}"
    try:  # the mark is written last, so a stage that was cut off is made again
        spark.read.text(f"{path}/done").first()
        return spark.read.parquet(f"{path}/rows")
    except AnalysisException:
        rows = make()
    rows.write.mode("overwrite").parquet(f"{path}/rows")
    spark.range(1).selectExpr("'done' AS value").write.mode("overwrite").text(f"{path}/done")
    return spark.read.schema(rows.schema).parquet(f"{path}/rows")


def diagnostics(totals: DataFrame, largest: DataFrame, expected: DataFrame) -> DataFrame:
    """One row for each extract: its totals, its largest level-4 feature ``extract, name, area``, and whether that is the expected one."""
    top = largest.groupBy("extract").agg(F.max(F.struct("area", "name")).alias("top"))
    rows = totals.join(top, "extract", "left").join(expected.select("extract", F.col("name").alias("expected_name")), "extract", "left")
    found = largest.join(expected, ["extract", "name"], "left_semi").select("extract").distinct().withColumn("found", F.lit(True))
    return rows.join(found, "extract", "left").select(*totals.columns, "expected_name", F.coalesce("found", F.lit(False)).alias("expected_found"), F.col("top.name").alias("largest_name"), F.col("top.area").alias("largest_area"))


def write_report(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").csv(path, header=True)


def stage_key(listing: DataFrame, group: str) -> DataFrame:
    """A fingerprint of each group's files (name, size, time): a stage is reused where its key is there already."""
    return list_digest(listing, group, F.concat_ws("|", "name", "size", "mtime"), "stage_key")


def ordered_index(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with their dense place from 1 in a global order."""
    return with_offsets(rows, order, {}).withColumn("place", F.col("index") + 1).drop("index")
