"""Content-addressed snapshots: stored under their hash, verified whenever they are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factspan.functions.text import object_key, snapshot_id


def fetched(spark: SparkSession, path: str) -> DataFrame:
    """(path, content, content_hash, byte_size) of files; each is read whole by one task."""
    rows = spark.read.format("binaryFile").load(path)
    return rows.select("path", "content", F.sha2("content", 256).alias("content_hash"), F.col("length").alias("byte_size"))


def snapshots(rows: DataFrame, source: str = "source_id") -> DataFrame:
    """Fetched rows with their snapshot id and where their content lies."""
    digest = F.col("content_hash")
    return rows.withColumn("id", snapshot_id(F.col(source), digest)).withColumn("object_uri", object_key(digest))


def first_fetches(rows: DataFrame, content: str, order: str) -> DataFrame:
    """One row per content: hash, first id, number of fetches, size."""
    c = F.col(content)
    return rows.groupBy(F.sha2(c, 256).alias("h")).agg(F.min(order).alias("first_doc"), F.count("*").alias("fetches"), F.max(F.octet_length(c).cast("long")).alias("byte_size"))


def verify(spark: SparkSession, path: str, content_hash: str, byte_size: int) -> None:
    """Raise unless the file's bytes are exactly those of the snapshot."""
    found = fetched(spark, path).select("content_hash", "byte_size").first()
    if found is None or (found.content_hash, found.byte_size) != (content_hash, byte_size):
        raise ValueError(f"{path} is not the snapshot that was recorded")


def verified_text(spark: SparkSession, path: str, content_hash: str, byte_size: int) -> DataFrame:
    """(value): the file as text, from the very bytes that are hashed; the scan fails if they aren't the snapshot's."""
    right = (F.col("content_hash") == content_hash) & (F.col("byte_size") == byte_size)
    fault = F.raise_error(F.concat("path", F.lit(" is not the snapshot that was recorded"))).cast("string")
    return fetched(spark, path).select(F.when(right, F.decode("content", "UTF-8")).otherwise(fault).alias("value"))


def feature_type(properties: str, *more: str) -> str:
    return f"struct<{''.join(f'{m},' for m in more)}properties:struct<{properties}>,geometry:struct<type:string,coordinates:string>>"


def feature_columns(feature: DataFrame) -> DataFrame:
    return feature.select("properties.*", F.col("geometry.type").alias("geometry_type"), F.col("geometry.coordinates").alias("coordinates"))


def read_geojson(spark: SparkSession, path: str, properties: str, content_hash: str | None = None, byte_size: int | None = None) -> DataFrame:
    """A FeatureCollection as rows: the properties named in the DDL, geometry_type, coordinates (JSON).

    One document is one task, and at most 2 GB; ``geojson.read_collection`` takes large ones apart. With a
    hash and size the bytes parsed are the bytes verified.
    """
    text = spark.read.text(path, wholetext=True) if content_hash is None else verified_text(spark, path, content_hash, byte_size)
    document = F.from_json(F.regexp_replace("value", r"^\x{feff}", ""), f"features array<{feature_type(properties)}>", {"mode": "FAILFAST"})
    return feature_columns(text.select(F.inline(document["features"])))


def read_features(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """The same rows from files with each feature on a line of its own, split among as many tasks as the size asks for.

    Such are newline-delimited features, with or without record separators, and collections that
    were written a feature a line. Lines that name no feature open or close the collection; a line
    with a part of a feature, or with a whole collection, is an error.
    """
    line = F.regexp_replace("value", r"^[\x{feff}\x1e\s]+|[\s,]+$", "")
    rows = spark.read.text(path).select(line.alias("line")).where(F.col("line").rlike(r'"type"\s*:\s*"Feature"'))
    kind = feature_type(properties, "type:string")
    parsed = rows.select(F.inline(F.from_json(F.concat(F.lit("["), "line", F.lit("]")), f"array<{kind}>", {"mode": "FAILFAST"})))
    whole = F.when(F.col("type") == "Feature", True).otherwise(F.raise_error(F.lit("a line holds something else than whole features")).cast("boolean"))
    return feature_columns(parsed.where(whole))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, every column a string; a byte order mark is not part of a name."""
    return spark.read.option("header", True).option("inferSchema", False).option("multiLine", True).option("escape", '"').csv(path)


def property_keys(features: DataFrame, properties: str) -> DataFrame:
    """Per key of the properties (JSON text): in how many features it is there, and there but null."""
    pairs = features.select(F.explode(F.from_json(properties, "map<string,string>")).alias("k", "v"))
    return pairs.groupBy("k").agg(F.count("*").alias("present"), F.count_if(F.col("v").isNull()).alias("null_values"))
