"""Readers: staged text, typed tables, polygons, a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampNTZType

READINGS = StructType([
    StructField("tmc_code", StringType()), StructField("measurement_tstamp", TimestampNTZType()), StructField("speed", DoubleType()),
    StructField("historical_average_speed", DoubleType()), StructField("reference_speed", DoubleType()), StructField("travel_time_minutes", DoubleType()),
    StructField("data_density", StringType()),
])
SEGMENTS = StructType([
    StructField("tmc", StringType()), StructField("road", StringType()), StructField("direction", StringType()), StructField("intersection", StringType()),
    StructField("county", StringType()), StructField("start_latitude", DoubleType()), StructField("start_longitude", DoubleType()), StructField("end_latitude", DoubleType()),
    StructField("end_longitude", DoubleType()), StructField("miles", DoubleType()), StructField("road_order", DoubleType()), StructField("tmclinear", StringType()),
    StructField("frc", IntegerType()), StructField("f_system", IntegerType()), StructField("urban_code", IntegerType()), StructField("thrulanes", IntegerType()),
    StructField("aadt", IntegerType()), StructField("active_start_date", DateType()), StructField("active_end_date", DateType()),
])


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a headed CSV file as text, untyped: the staging table."""
    names = [f.name for f in READINGS]
    return spark.read.csv(path, header=True, schema=StructType([StructField(n, StringType()) for n in names]), nullValue="\0")


def typed_readings(staged: DataFrame) -> DataFrame:
    """Staged text as typed readings: empty text is null, text that is no number fails the job."""
    columns = []
    for field in READINGS:
        text = F.nullif(F.col(field.name).cast("string"), F.lit(""))
        columns.append(text.cast(field.dataType).alias(field.name))
    return staged.select(*columns)


def with_new_columns(df: DataFrame, **defaults: object) -> DataFrame:
    """Columns that newer schemas add, filled with their defaults where a table lacks them."""
    for name, value in defaults.items():
        df = df.withColumn(name, F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value))
    return df


def read_database(spark: SparkSession, url: str, query: str, partition: tuple[str, str, str, int] | None = None, **options: str) -> DataFrame:
    """A query's rows over JDBC; partition is (column, lower, upper, number) for parallel reads."""
    return database_reader(spark, url, query, partition, **options).load()


def database_reader(spark: SparkSession, url: str, query: str, partition: tuple[str, str, str, int] | None = None, **options: str):
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition is None:
        return reader.option("query", query)
    column, lower, upper, number = partition
    reader = reader.option("dbtable", f"({query}) AS source").option("partitionColumn", column)
    return reader.option("lowerBound", lower).option("upperBound", upper).option("numPartitions", str(number))


def read_polygons(spark: SparkSession, path: str, name: str = "name", exterior_only: bool = False) -> DataFrame:
    """Vertices (name, file_order, ring, i, x, y) of a GeoJSON file's named polygons.

    Rings of a MultiPolygon are numbered through. Features without a name are skipped.
    """
    features = spark.read.schema(f"features array<struct<{FEATURE}>>").json(path, multiLine=True).select(F.posexplode("features").alias("file_order", "f"))
    return vertices(features.select("file_order", "f.*"), name, exterior_only)


def read_polygon_lines(spark: SparkSession, path: str, name: str = "name", order: str = "file_order", exterior_only: bool = False) -> DataFrame:
    """The same for files with a feature on each line: many tasks read them, and a property gives their order."""
    features = spark.read.schema(FEATURE).json(path)
    return vertices(features.withColumn("file_order", F.col("properties")[order].cast("int")), name, exterior_only)


FEATURE = "properties map<string,string>, geometry struct<type:string,coordinates:string>"


def vertices(features: DataFrame, name: str, exterior_only: bool) -> DataFrame:
    point = "array<array<array<array<double>>>>"
    named = features.select("file_order", F.col("properties")[name].alias("name"), "geometry.type", F.col("geometry.coordinates").alias("c")).where("name is not null")
    rings = F.when(F.col("type") == "MultiPolygon", F.from_json("c", point)).otherwise(F.array(F.from_json("c", "array<array<array<double>>>")))
    kept = F.flatten(F.transform(rings, lambda polygon: F.slice(polygon, 1, 1))) if exterior_only else F.flatten(rings)
    each = named.select("name", "file_order", F.posexplode(kept).alias("ring", "points"))
    return each.select("name", "file_order", "ring", F.posexplode("points").alias("i", "p")).select("name", "file_order", "ring", "i", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))
