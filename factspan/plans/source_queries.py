"""Queries that go through files: what sources write and read, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from factspan.operators import names
from factspan.plans.registry import query
from factspan.sources import geojson, stream


@query("""select s_suppkey id, s_name || '}"{[\\' as name, s_nationkey nation, 'Polygon' geometry_type, '[[[' || s_suppkey || ',0],[' || s_suppkey || ',1],[0,1],[' || s_suppkey || ',0]]]' coordinates from supplier""")
def geojson_features(spark, read):
    """Suppliers written as collections of one line, and read again in splits."""
    k = F.col("s_suppkey").cast("string")
    ring = F.concat(F.lit("[[["), k, F.lit(",0],["), k, F.lit(",1],[0,1],["), k, F.lit(",0]]]"))
    properties = F.struct(F.col("s_suppkey").alias("id"), F.concat("s_name", F.lit('}"{[\\')).alias("name"), F.col("s_nationkey").alias("nation"))
    path = geojson.scratch(spark, "features")
    geojson.write_collection(read("supplier").select(properties.alias("properties"), F.lit("Polygon").alias("geometry_type"), ring.alias("coordinates")), path)
    return geojson.read_collection(spark, path, "id long, name string, nation int")


def _name_files(spark, read) -> str:
    """A file for each nation with the names of its suppliers, a line each."""
    path = geojson.scratch(spark, "names")
    rows = read("supplier").select("s_nationkey", "s_suppkey", "s_name").repartition("s_nationkey").sortWithinPartitions("s_nationkey", "s_suppkey")
    rows.select("s_nationkey", F.col("s_name").alias("value")).write.partitionBy("s_nationkey").text(path)
    return f"{path}/*/"


def _nation():
    return F.regexp_extract("path", r"s_nationkey=(\d+)", 1).cast("int").alias("nation")


@query("select s_nationkey nation, sum(length(s_name) + 1) byte_size, sha256(string_agg(s_name || chr(10), '' order by s_suppkey)) content_hash from supplier group by 1")
def file_digests(spark, read):
    """Digests of files that are read as streams."""
    return stream.digests(spark, _name_files(spark, read), chunk=7).select(_nation(), "byte_size", "content_hash")


@query("""with f as (select s_nationkey nation, string_agg(s_name || chr(10), '' order by s_suppkey) t from supplier group by 1)
 select nation, length(t) byte_size, least(40, length(t)) probed, contains(substr(t, 1, 40), '7' || chr(10)) has_seven from f""")
def file_probes(spark, read):
    """What the first bytes of files hold."""
    probes = stream.prefixes(spark, _name_files(spark, read), 40)
    return probes.select(_nation(), "byte_size", F.octet_length("prefix").alias("probed"), stream.has_bytes(F.col("prefix"), "7\n").alias("has_seven"))


@query("""with recursive n as (select distinct w as name from (select unnest(string_split(text, ' ')) w from benchmark) where length(w) between 9 and 12),
 m as (select doc_id, name, text, strpos(text, name) i from documents, n where contains(text, name) union all select doc_id, name, text, i + strpos(substr(text, i + 1), name) from m where strpos(substr(text, i + 1), name) > 0)
 select doc_id, name, i - 1 start from m""")
def names_in_texts(spark, read):
    """Every place of every long word of the benchmark in all documents."""
    words = read("benchmark").select(F.explode(F.split("text", " ")).alias("name")).where(F.length("name").between(9, 12))
    return names.occurrences(read("documents"), words, "doc_id", "text")
