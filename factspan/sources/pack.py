"""Jurisdiction packs: small YAML registries, checked as they are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SOURCE = "id string, display_name string, steward string, method string, licence string, phase_status string, phase_status_reason string, cadence_stated string, supplies array<string>"
_REQUIRED = ("id", "licence", "phase_status")


def _document(spark: SparkSession, path: str) -> dict:
    import yaml

    text = spark.read.text(path, wholetext=True).first()
    held = yaml.safe_load(text.value) if text else None
    if not isinstance(held, dict) or "jurisdiction" not in held:
        raise ValueError(f"{path} is no pack")
    return held


def read_sources(spark: SparkSession, path: str) -> tuple[str, DataFrame]:
    """(jurisdiction, its declared sources). A pack is a registry file: it is read whole, once."""
    held = _document(spark, path)
    rows = held.get("sources") or []
    lacking = [(r.get("id"), k) for r in rows for k in _REQUIRED if not r.get(k)]
    if lacking:
        raise ValueError(f"{path} lacks {lacking}")
    names = [c.split()[0] for c in _SOURCE.split(", ")]
    return held["jurisdiction"], spark.createDataFrame([[r.get(n) if n != "supplies" else list(r.get(n) or []) for n in names] for r in rows], _SOURCE)


def read_licences(spark: SparkSession, path: str) -> DataFrame:
    """(id, display_name) of the declared licences; a repeated id is an error."""
    rows = _document(spark, path).get("licences") or []
    ids = [r["id"] for r in rows]
    if len(ids) != len(set(ids)):
        raise ValueError(f"{path} repeats {sorted({i for i in ids if ids.count(i) > 1})}")
    return spark.createDataFrame([[r["id"], r.get("display_name")] for r in rows], "id string, display_name string")
