"""Audits: provenance of snapshots, conformance of packs, liveness of sources, drift of schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def good_status(status: Column) -> Column:
    """A 2xx status; an unknown one isn't."""
    return F.coalesce(status.between(200, 299), F.lit(False))


def flagged_snapshots(snapshots: DataFrame, objects: DataFrame) -> DataFrame:
    """(id, reason): snapshots whose bytes are missing or hash to something else, or that weren't 2xx.

    objects: object_uri and content, as a binary file scan gives them.
    """
    hashed = objects.select("object_uri", F.sha2("content", 256).alias("_hash"), F.octet_length("content").cast("long").alias("_size"))
    seen = snapshots.join(hashed, "object_uri", "left")
    reasons = F.array(
        F.when(F.col("_hash").isNull(), "unreadable"),
        F.when((F.col("_hash") != F.col("content_hash")) | (F.col("_size") != F.col("byte_size")), "content_mismatch"),
        F.when(~good_status(F.col("http_status")), "status"),
    )
    return seen.select("id", F.explode(F.filter(reasons, lambda r: r.isNotNull())).alias("reason"))


def facts_citing(facts: DataFrame, flagged: DataFrame) -> DataFrame:
    """Facts by flagged snapshot, as sorted lists."""
    bad = facts.join(flagged.select(F.col("id").alias("snapshot_id")).distinct(), "snapshot_id", "left_semi")
    return bad.groupBy("snapshot_id").agg(F.count("*").alias("n_facts"), F.sort_array(F.collect_set("field_key")).alias("field_keys"))


def run_status(fetched: DataFrame, content: str, order: str, status: Column | None = None) -> DataFrame:
    """failed if not 2xx; succeeded for the first fetch of its content; else skipped_unchanged."""
    from pyspark.sql import Window

    first = F.row_number().over(Window.partitionBy(F.sha2(F.col(content), 256)).orderBy(order)) == 1
    st = F.when(first, "succeeded").otherwise("skipped_unchanged")
    return fetched.withColumn("st", st if status is None else F.when(~good_status(status), "failed").otherwise(st))


def previous_load(runs: DataFrame, by: list[str]) -> DataFrame:
    """The latest successful *load* of each source: fetches anchor nothing."""
    from factspan.operators.current import top_per_group

    return top_per_group(runs.where("status = 'succeeded' and kind = 'load'"), by, [F.col("finished_at").desc(), F.col("started_at").desc(), F.col("id")])


def prefix_fields(pages: DataFrame, content: str, probes: dict[str, tuple[str, int]]) -> DataFrame:
    """``pages`` with one flag per probe: whether the text stands in the first n characters."""
    flags = [F.contains(F.substring(F.col(content), 1, n), F.lit(text)).alias(name) for name, (text, n) in probes.items()]
    return pages.select("*", *flags)


def missing_fields(sources: DataFrame, declared: str, prefix: str) -> DataFrame:
    """Sources whose answer lacks declared fields: id, missing_fields (schema drift)."""
    lacking = F.filter(F.col(declared), lambda f: ~F.contains(F.col(prefix), f))
    return sources.withColumn("missing_fields", lacking).where(F.size("missing_fields") > 0)


def key_coverage(rows: DataFrame, json: str) -> DataFrame:
    """How many rows have each top-level key of a JSON column."""
    return rows.select(F.explode(F.json_object_keys(json)).alias("k")).groupBy("k").agg(F.count("*").alias("present"))


def conformance(pack: DataFrame, registry: DataFrame, licences: DataFrame, fields: DataFrame, jurisdiction: str) -> DataFrame:
    """Failures of a pack's active sources against the registry: (id, failure, detail).

    pack: id, phase_status, licence, supplies; registry: id, licence_id, expected_fields. Sources
    of other stewards (another prefix) aren't looked up.
    """
    own = pack.where((F.col("phase_status") == "active") & F.col("id").startswith(jurisdiction + "."))
    seen = own.join(registry.withColumn("_there", F.lit(True)), "id", "left").join(licences.select(F.col("id").alias("licence"), F.lit(True).alias("_licence")), "licence", "left")
    there = F.col("_there").isNotNull()
    one = lambda cond, name, detail: F.when(cond, F.struct(F.lit(name).alias("failure"), detail.alias("detail")))
    listed = lambda a, b: F.array_sort(F.array_except(a, b))
    text = lambda a: F.array_join(a, ",")
    extra, lacking = listed(F.col("supplies"), F.col("expected_fields")), listed(F.col("expected_fields"), F.col("supplies"))
    found = F.array(
        one(~there, "source_missing", F.lit("")),
        one(F.col("_licence").isNull(), "licence_missing", F.col("licence")),
        one(there & (F.col("licence") != F.col("licence_id")), "licence_differs", F.col("licence_id")),
        one(there & (F.size(extra) > 0), "supplies_unexpected", text(extra)),
        one(there & (F.size(lacking) > 0), "supplies_lacking", text(lacking)),
    )
    direct = seen.select("id", F.inline(F.filter(found, lambda f: f.isNotNull())))
    undefined = own.select("id", F.explode("supplies").alias("field_key")).join(fields.select("field_key"), "field_key", "left_anti")
    return direct.unionByName(undefined.select("id", F.lit("field_undefined").alias("failure"), F.col("field_key").alias("detail")))


def vocabulary_diff(terms: DataFrame, term: str, **held: Column) -> DataFrame:
    """Terms that some of the vocabularies have and others lack: term, and a flag for each. ``held``: whether a row is of that vocabulary."""
    flags = terms.groupBy(term).agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in held.items()])
    number = sum((F.col(n).cast("int") for n in held), F.lit(0))
    return flags.where((number > 0) & (number < len(held)))


def type_histogram(rows: DataFrame, by: str, json: str) -> DataFrame:
    """(by, key, kind, n): of which JSON kind each top-level key's values are; null counts as missing."""
    pairs = rows.select(by, F.explode(F.from_json(json, "map<string,string>")).alias("key", "_v"))
    kind = (
        F.when(F.col("_v").isNull(), "missing").when(F.col("_v").isin("true", "false"), "boolean").when(F.col("_v").rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"), "number")
        .when(F.col("_v").startswith("{"), "object").when(F.col("_v").startswith("["), "array").otherwise("string")
    )
    return pairs.groupBy(by, "key", kind.alias("kind")).agg(F.count("*").alias("n"))


def schema_drift(expected: dict[str, str], tables: dict[str, DataFrame]) -> list[tuple[str, str]]:
    """(table, what differs) between committed schemas (as JSON) and tables."""
    out = [(t, "missing") for t in expected if t not in tables] + [(t, "unexpected") for t in tables if t not in expected]
    return sorted(out + [(t, "differs") for t in expected if t in tables and tables[t].schema.json() != expected[t]])
