"""Every occurrence of every name in texts, by one automaton for all names.

The names' automaton (Aho and Corasick) is built once in each task from the list that is sent
along, so a text is read once however many names there are. The list is a registry; its size is
checked. Texts are searched whole. A null text holds nothing; empty names are refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def occurrences(texts: DataFrame, names: DataFrame, key: str, text: str, name: str = "name", most: int = 1_000_000) -> DataFrame:
    """(key, name, start) for every place of every name, overlapping ones too; start in code points. At most ``most`` names."""
    rows = names.select(name).distinct().limit(most + 1).collect()
    listed = sorted({r[0] for r in rows if r[0] is not None})
    if len(rows) > most or "" in listed:
        raise ValueError(f"names are a registry of at most {most} that aren't empty")
    kind = texts.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for n in listed:
            automaton.add_word(n, n)
        automaton.make_automaton()
        for b in batches:
            at, found, starts = [], [], []
            for k, t in enumerate(b.column(1).to_pylist()):
                for end, n in automaton.iter(t) if t and listed else ():
                    at.append(k)
                    found.append(n)
                    starts.append(end - len(n) + 1)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(found, pa.string()), pa.array(starts, pa.int64())], names=["_key", "name", "start"])

    return texts.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(run, f"_key {kind}, name string, start long").withColumnRenamed("_key", key)
