"""Tables as directories of runs, visible all together or not at all.

A run writes its rows of every table under ``<table>/run_id=<run>``; only when all are written
does its marker ``_commits/<run>.json`` appear, by an atomic rename. Readers see the runs that
have a marker. Nothing is ever rewritten: supersession is a log of its own, joined on reading.
All file access goes through Hadoop's file system, so the root may be in any store Spark reads.
"""

from __future__ import annotations

import json
import re
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a local session without it gets a temporary one, a cluster's is refused."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


class Tables:
    """Versioned tables under one root."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, str]):
        self.spark, self.root, self.schemas = spark, root.rstrip("/"), schemas
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def runs(self) -> list[str]:
        """Committed runs in order."""
        folder = self._path(f"{self.root}/_commits")
        if not self._fs.exists(folder):
            return []
        return sorted(s.getPath().getName().removesuffix(".json") for s in self._fs.listStatus(folder) if s.getPath().getName().endswith(".json"))

    def read(self, table: str, runs: list[str] | None = None) -> DataFrame:
        """The committed rows of a table; an unknown or empty one has its schema and no rows."""
        runs = self.runs() if runs is None else runs
        there = [f"{self.root}/{table}/run_id={r}" for r in runs if self._fs.exists(self._path(f"{self.root}/{table}/run_id={r}"))]
        if not there:
            return self.spark.createDataFrame([], self.schemas[table])
        return self.spark.read.schema(self.schemas[table]).parquet(*there)

    def commit(self, run: str, rows: dict[str, DataFrame], validate: Callable[[Tables, str], list[str]] | None = None, known: list[str] | None = None) -> None:
        """Write all rows of a run, validate them with what is committed, and make them visible.

        known: the runs that were read to make the rows, those of now if not told. A run that was
        committed meanwhile by another writer makes this one fail before it is visible; a scheduler
        still has to keep two writers from setting their markers at the same moment.
        """
        known = self.runs() if known is None else known
        if run in self.runs():
            raise ValueError(f"run {run} is committed already")
        for table, df in rows.items():
            columns = [F.col(x.name).cast(x.dataType).alias(x.name) for x in self.spark.createDataFrame([], self.schemas[table]).schema]
            df.select(*columns).write.mode("overwrite").parquet(f"{self.root}/{table}/run_id={run}")
        broken = validate(self, run) if validate else []
        if broken:
            raise ValueError(f"run {run} breaks {', '.join(broken)}")
        if self.runs() != known:
            raise ValueError(f"run {run} has not seen {', '.join(sorted(set(self.runs()) - set(known)))}")
        marker, waiting = self._path(f"{self.root}/_commits/{run}.json"), self._path(f"{self.root}/_commits/.{run}.tmp")
        out = self._fs.create(waiting, True)
        out.write(bytearray(json.dumps({"run": run, "tables": sorted(rows)}).encode()))
        out.close()
        if not self._fs.rename(waiting, marker):
            raise ValueError(f"run {run} was committed by another writer")


def facts_as_of_now(fact: DataFrame, supersession: DataFrame) -> DataFrame:
    """Facts with their superseded_at from the supersession log (fact_id, superseded_at)."""
    log = supersession.groupBy(F.col("fact_id").alias("id")).agg(F.min("superseded_at").alias("_end"))
    return fact.drop("superseded_at").join(log, "id", "left").withColumnRenamed("_end", "superseded_at")
