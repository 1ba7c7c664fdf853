"""Feature collections of any size and layout, read in as many tasks as Spark splits their files into.

A collection on one line has no line ends to split at, and from the middle of a file nothing says
whether a brace is JSON or part of a text. So it is read twice, both times by Spark's own text
reader with "}" as the line separator, which splits a file anywhere and reads every store that
Spark reads:

1. Each split is summed up for both cases, that it begins outside of a text or inside of one: how
   many quotes it has, and by how much braces and brackets outside of texts rise. An escape is
   never cut, for "}" can't be escaped. A row per split comes out of it.
2. Two running sums over a file's splits say in which case, and how deep, each of them begins.
3. With that each split gives its whole features, found by depth alone, and the pieces of those
   that its ends cut. The pieces (two for a split at most) are put together by the split in which
   their feature begins, however many splits it goes on for.

A feature is an object in an array of the outermost object; what is no feature there is left out,
as are other members. Features are parsed by ``from_json`` and a broken one is an error. An empty
file has no features.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factspan.sources.snapshot import feature_columns, feature_type
from factspan.sources.tables import shared_folder

_OPEN_B, _CLOSE_B, _OPEN_K, _CLOSE_K, _QUOTE, _BACK = b"{}[]\"\\"


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "}").text(path)
    return text.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))


def _joined(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], list, np.ndarray]]:
    """(split, its further columns, bytes) of the splits of a batch; each piece ends in the brace that was its separator."""
    values, rest = batch.column(0).to_pylist(), [c.to_pylist() for c in batch.columns[1:]]
    begin = 0
    for k in range(1, len(values) + 1):
        if k == len(values) or (rest[0][k], rest[1][k]) != (rest[0][begin], rest[1][begin]):
            text = "}".join(values[begin:k]) + "}"
            yield (rest[0][begin], rest[1][begin]), [c[begin] for c in rest[2:]], np.frombuffer(text.encode(), np.uint8)
            begin = k


def _quotes(raw: np.ndarray) -> np.ndarray:
    """Where texts begin or end: quotes that no backslash escapes."""
    quote = raw == _QUOTE
    before = np.flatnonzero(quote[1:] & (raw[:-1] == _BACK)) + 1
    for at in before:
        run = 1
        while at - run - 1 >= 0 and raw[at - run - 1] == _BACK:
            run += 1
        if run % 2:
            quote[at] = False
    return quote


def _steps(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By how much braces and brackets rise at each byte."""
    return (raw == _OPEN_B).astype(np.int8) - (raw == _CLOSE_B), (raw == _OPEN_K).astype(np.int8) - (raw == _CLOSE_K)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, start, quotes, and the rise of braces and brackets if the split begins outside of a text, and inside)."""
    now, sums = None, None

    def told():
        names = ["path", "start", "quotes", "braces", "brackets", "braces_in", "brackets_in"]
        return pa.RecordBatch.from_arrays([pa.array([now[0]]), *[pa.array([int(v)], pa.int64()) for v in (now[1], *sums)]], names=names)

    for batch in batches:
        for split, _, raw in _joined(batch):
            if split != now:
                if now:
                    yield told()
                now, sums = split, [0, 0, 0, 0, 0]
            quote = _quotes(raw)
            inside = ((np.cumsum(quote) + sums[0]) & 1).astype(bool)
            for k, steps in enumerate(_steps(raw)):
                sums[1 + k] += steps[~inside].sum(dtype=np.int64)
                sums[3 + k] += steps[inside].sum(dtype=np.int64)
            sums[0] += int(quote.sum())
    if now:
        yield told()


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, start, seq, kind, text): whole features (kind 0), those that a split's end cuts (1), and what goes on from an earlier split (2)."""
    now, inside, braces, brackets, held, seq = None, False, 0, 0, None, 0
    kind = 0

    def rows(found):
        schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("seq", pa.int64()), ("kind", pa.int32()), ("text", pa.string())])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

    def cut_off():
        """What the end of a split leaves open: all of it, if it began before."""
        return (*now, seq, kind or 1, b"".join(held).decode()) if held else None

    for batch in batches:
        found = []
        for split, state, raw in _joined(batch):
            if split != now:
                if now and (rest := cut_off()):
                    found.append(rest)
                now, (inside, braces, brackets), seq = split, state, 0
                held, kind = ([], 2) if braces > 1 and brackets > 0 else (None, 0)
            text = raw.tobytes()
            within = ((np.cumsum(_quotes(raw)) + inside) & 1).astype(bool)
            b, k = _steps(raw)
            b[within], k[within] = 0, 0
            at = np.flatnonzero(b)
            depth, nest = np.cumsum(b[at], dtype=np.int64) + braces, (np.cumsum(k, dtype=np.int64) + brackets)[at]
            edge = (nest == 1) & ((b[at] > 0) & (depth == 2) | (b[at] < 0) & (depth == 1))
            after = 0
            for place, opens in zip(at[edge].tolist(), (b[at] > 0)[edge].tolist(), strict=True):
                if opens:
                    held, kind, after = [], 0, place
                elif held is not None:
                    held.append(text[after : place + 1])
                    found.append((*now, seq, kind, b"".join(held).decode()))
                    held, kind, seq = None, 0, seq + 1
            if held is not None:
                held.append(text[after:])
            inside = bool(within[-1])
            braces, brackets = braces + int(b.sum(dtype=np.int64)), brackets + int(k.sum(dtype=np.int64))
            if len(found) >= 5000:
                yield rows(found)
                found = []
        if found:
            yield rows(found)
    if now and (rest := cut_off()):
        yield rows([rest])


def split_states(spark: SparkSession, path: str) -> DataFrame:
    """(path, start, inside, braces, brackets): how each split begins. A row for each split, 128 MB by default."""
    sums = _pieces(spark, path).mapInArrow(_sums, "path string, start long, quotes long, braces long, brackets long, braces_in long, brackets_in long")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    cased = sums.select("path", "start", inside.alias("inside"), *[F.when(inside, F.col(f"{c}_in")).otherwise(F.col(c)).alias(c) for c in ("braces", "brackets")])
    return cased.select("path", "start", "inside", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("braces", "brackets")])


def feature_texts(spark: SparkSession, path: str) -> DataFrame:
    """(text): the features of collections as JSON, each in the task that read it."""
    states = split_states(spark, path)
    pieces = _pieces(spark, path).join(F.broadcast(states), ["path", "start"])
    found = pieces.select("value", "path", "start", "inside", "braces", "brackets").mapInArrow(_features, "path string, start long, seq long, kind int, text string")
    cut = found.where("kind > 0")
    order = Window.partitionBy("path").orderBy("start", "seq")
    cut = cut.withColumn("owner", F.last(F.when(F.col("kind") == 1, F.col("start")), ignorenulls=True).over(order))
    told = cut.groupBy("path", "owner").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "seq", "text"))), lambda x: x["text"]), "").alias("text"))
    return found.where("kind = 0").select("text").unionByName(told.select("text"))


def read_collection(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """The rows of ``read_geojson``, from files of any size: the properties named in the DDL, geometry_type, coordinates (JSON)."""
    parsed = feature_texts(spark, path).select(F.from_json("text", feature_type(properties, "type:string"), {"mode": "FAILFAST"}).alias("f"))
    return feature_columns(parsed.select("f.*").where("type = 'Feature'"))


def write_collection(features: DataFrame, path: str) -> None:
    """features(properties struct, geometry_type, coordinates as JSON) as files of one line, a collection for each task."""
    text = F.concat(F.lit('{"type":"Feature","properties":'), F.to_json("properties"), F.lit(',"geometry":'), F.coalesce(F.concat(F.lit('{"type":"'), F.col("geometry_type"), F.lit('","coordinates":'), F.col("coordinates"), F.lit("}")), F.lit("null")), F.lit("}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = '{"type":"FeatureCollection","features":['
        for b in batches:
            out = []
            for t in b.column(0).to_pylist():
                out.append(before + t)
                before = ","
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]}" if before == "," else before + "]}"], pa.string())], names=["value"])

    features.select(text.alias("value")).mapInArrow(run, "value string").write.option("lineSep", " ").text(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
