"""Structured Streaming over the same operators: arriving snapshots and detector findings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def incoming(spark: SparkSession, path: str, schema: str, max_files: int = 16) -> DataFrame:
    """Parquet snapshots as they arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def reconcile_each(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, str], None], **trigger) -> StreamingQuery:
    """Call ``apply(snapshot, run)`` for every micro-batch.

    The run is named by the batch, so a batch that is replayed after a failure commits under the
    same name, and a commit that already happened is refused by the tables, not repeated.
    """

    def each(batch: DataFrame, n: int) -> None:
        if not batch.isEmpty():
            apply(batch, f"batch-{n:012d}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def first_sightings(stream: DataFrame, content: str, at: str, lateness: str) -> DataFrame:
    """Each content once within the watermark, as ON CONFLICT DO NOTHING would keep it."""
    hashed = stream.withColumn("content_hash", F.sha2(F.col(content), 256))
    return hashed.withWatermark(at, lateness).dropDuplicatesWithinWatermark(["content_hash"])


def findings_per_window(stream: DataFrame, at: str, detector: str, window: str, lateness: str) -> DataFrame:
    """Findings by detector and window, closed once the watermark has passed."""
    return stream.withWatermark(at, lateness).groupBy(F.window(at, window), F.col(detector)).agg(F.count("*").alias("n"))


#: parcel_id, reason -> open or not, since when, how often it was opened.
LIFECYCLE = "parcel_id string, reason string, event string, at timestamp, openings long"


def exception_lifecycle(findings: DataFrame, subject: tuple[str, str] = ("parcel_id", "reason"), at: str = "at") -> DataFrame:
    """Events opened, reopened and cleared, from a stream of (subject, at, holds).

    State per subject is three numbers, however many findings it gets.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        is_open, openings, last = state.get if state.exists else (False, 0, 0)
        out = []
        for f in sorted((r for b in batches for r in b[[at, "holds"]].itertuples(index=False)), key=lambda r: (r[0], r[1])):
            when = int(pd.Timestamp(f[0]).value)
            if when < last:  # older than what is known: it changes nothing
                continue
            last = when
            if bool(f[1]) != is_open:
                is_open = bool(f[1])
                openings += is_open
                event = "cleared" if not is_open else "opened" if openings == 1 else "reopened"
                out.append((*map(str, key), event, f[0], openings))
        state.update((is_open, openings, last))
        yield pd.DataFrame(out, columns=["parcel_id", "reason", "event", "at", "openings"])

    return findings.groupBy(*subject).applyInPandasWithState(step, LIFECYCLE, "is_open boolean, openings long, last long", "append", GroupStateTimeout.NoTimeout)
