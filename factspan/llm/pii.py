r"""PII: patterns find the protected entities, information theory finds what gives them away.

Base spans are e-mail addresses, IPv4 addresses, card numbers (16 to 19 digits, Luhn) and phone
numbers, found by pattern in every whole text. The corpus then says which ordinary terms reveal
them: with N documents, n(e) of them holding entity e, n(t) holding term t, and n(t, e) with t
near e, the pointwise mutual information log2(N n(t, e) / (n(t) n(e))) is the part of e's
information log2(N / n(e)) that t discloses. All four count documents. A term is removed where it
discloses ``remove_at`` of some entity or more, and generalised where it discloses ``generalise_at``
or more, wherever it stands in any text. A pair is evidence only if it is seen in ``support``
different texts at least: groups of identical or near-identical whole texts (SimHash fingerprints
linked as in ``simhash``) count as one text there, so a passage that is only copied proves nothing.

How it runs: three passes over the texts, none of which shuffles them. The first finds entities,
and for documents that hold one the terms near it and the fingerprint; pairs are sums of those
short rows, and pairs that can't reach a threshold are out at once, since n(t) is at least the
number of documents with t near any entity. The second counts the documents with each remaining
term, in every task before it is shuffled. The third gives the spans of every document. Terms go
to the tasks while their counted number is within ``broadcast_terms``; beyond it all terms are
counted, and what stands where meets the disclosing terms in a shuffle.

Nulls: a null text is the empty text; null ids pass through; repeated rows are documents each.
Terms are runs of letters and digits, of any length, lower-cased and outside of base spans; those
within ``NEAR`` code points of an entity are near it. Spans count code points, ends are exclusive. Patterns are
applied in forms that take linear time on any text, however long. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factspan.llm.common import connected_components, cut, parts
from factspan.llm.simhash import fingerprint, links

KINDS = ("email", "ip", "card", "phone")
NEAR = 100
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_OTHER = re.compile(r"[^0-9]+")
_TERM = re.compile(r"[^\W_]+")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the address pattern, leftmost and not overlapping, read outward from each @."""
    done = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            done = m.end()
            yield start, done


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as in ``KINDS``, then start."""
    out = [("email", s, e) for s, e in emails(text)]
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _OTHER.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_OTHER.sub("", m[0])) <= 15]
    return out


def entity(kind: str, value: str) -> int:
    """The same entity in any of its spellings, as a signed long."""
    plain = value.lower() if kind in ("email", "ip") else _OTHER.sub("", value)
    return xxhash.xxh64_intdigest(f"{kind}:{plain}") - (1 << 63)


def _outside(found: list[tuple[int, int]], spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Those of ``found`` that overlap none of ``spans``."""
    taken = sorted((s, e) for _, s, e in spans)
    begins, reach = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
    return [(s, e) for s, e in found if not (k := bisect_right(begins, e - 1)) or reach[k - 1] <= s]


def context(text: str, spans: list[tuple[str, int, int]]) -> set[tuple[int, str | None]]:
    """(entity, term) for the terms near each span, and (entity, None) for each entity."""
    out = set()
    for kind, start, end in spans:
        who, near = entity(kind, text[start:end]), []
        for lo, hi in ((max(0, start - NEAR), start), (end, min(len(text), end + NEAR))):
            for m in _TERM.finditer(text, lo, hi):
                s, e = m.span()
                if (s > lo or s == 0 or not text[s - 1].isalnum()) and (e < hi or e == len(text) or not text[e].isalnum()):
                    near.append((s, e))
        out.add((who, None))
        out.update((who, text[s:e].lower()) for s, e in _outside(near, spans))
    return out


def terms(text: str, wanted: frozenset[str] | None) -> dict[str, list[tuple[int, int]]]:
    """Where each of the ``wanted`` terms (None: every term) stands outside of base spans."""
    at = defaultdict(list)
    low = text.lower()
    if wanted is not None and wanted.isdisjoint(_TERM.findall(low)) and len(low) == len(text) and "Σ" not in text:  # lower-cased by its neighbours
        return at
    found = [m.span() for m in _TERM.finditer(text) if wanted is None or m[0].lower() in wanted]
    for s, e in _outside(found, base_spans(text)) if found else ():
        at[text[s:e].lower()].append((s, e))
    return at


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


_SPOTS = pa.list_(pa.struct([("s", pa.int32()), ("f", pa.int32()), ("action", pa.string())]))


def evidence(docs: DataFrame, text: str = "text") -> DataFrame:
    """(fp, e, t): for documents that hold entities, the fingerprint with each entity (t is null) and each term near it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in parts(b)):
            rows = []
            for said in part.column(0).to_pylist():
                if spans := base_spans(said or ""):
                    fp = fingerprint(said)
                    rows += [(fp - (1 << 64) if fp >> 63 else fp, e, t) for e, t in context(said, spans)]
            fps, es, ts = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(fps, pa.int64()), pa.array(es, pa.int64()), pa.array(ts, pa.string())], names=["fp", "e", "t"])

    return docs.select(text).mapInArrow(run, "fp long, e long, t string")


def counted(docs: DataFrame, text: str, wanted: frozenset[str] | None, most: int = 200_000) -> DataFrame:
    """(t, n): how many documents hold each of the ``wanted`` terms (None: each term) outside of base spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter()
        given = lambda: pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["t", "n"])
        for part in (p for b in batches for p in parts(b)):
            for said in part.column(0).to_pylist():
                seen.update(terms(said or "", wanted).keys())
            if len(seen) > most:
                yield given()
                seen.clear()
        yield given()

    return docs.select(text).mapInArrow(run, "t string, n long").groupBy("t").agg(F.sum("n").alias("n_t"))


def disclosing(docs: DataFrame, text: str = "text", generalise_at: float = 0.6, remove_at: float = 0.9, support: int = 3, broadcast_terms: int = 100_000) -> DataFrame:
    """(t, action): the terms that disclose some entity, and whether they are removed or generalised."""
    n = float(docs.count())
    near = cut(evidence(docs, text).groupBy("fp", "e", "t").agg(F.count("*").alias("n")), narrow=True)
    units = connected_components(links(near.select("fp").distinct()))
    pairs = near.where("t is not null").join(units, F.col("fp") == F.col("node"), "left").select(F.coalesce("component", "fp").alias("unit"), "e", "t", "n")
    pairs = pairs.groupBy("unit", "e", "t").agg(F.sum("n").alias("n")).groupBy("e", "t").agg(F.sum("n").alias("both"), F.count("*").alias("texts")).where(F.col("texts") >= support)
    holders = near.where("t is null").groupBy("e").agg(F.sum("n").alias("n_e"))
    # a document with t near several entities counts for the one that it is most often near: a lower bound of n(t)
    beside = near.where("t is not null").groupBy("e", "t").agg(F.sum("n").alias("n")).groupBy("t").agg(F.max("n").alias("n_beside"))
    disclosed = lambda n_t: F.log2(F.lit(n) * F.col("both") / (n_t * F.col("n_e"))) / F.nullif(F.log2(F.lit(n) / F.col("n_e")), F.lit(0.0))
    pairs = cut(pairs.join(holders, "e").join(beside, "t").where(disclosed(F.col("n_beside")) >= generalise_at).select("e", "t", "both", "n_e"), narrow=True)
    wanted = pairs.select("t").distinct()
    few = wanted.count() <= broadcast_terms
    df = counted(docs, text, frozenset(r.t for r in wanted.collect()) if few else None)
    told = pairs.join(df, "t").groupBy("t").agg(F.max(disclosed(F.col("n_t"))).alias("discloses")).where(F.col("discloses") >= generalise_at)
    return cut(told.select("t", F.when(F.col("discloses") >= remove_at, "remove").otherwise("generalise").alias("action")), narrow=True)


def _same(text: str) -> Column:
    """What stands for a whole text in joins, so that copies are one; null is the empty text."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def places(docs: DataFrame, told: DataFrame, text: str = "text") -> DataFrame:
    """(same, terms): where the terms ``told(t, action)`` stand in each distinct text, by a shuffle of all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in parts(b)):
            rows = [(same, t, s, f) for same, said in zip(*(c.to_pylist() for c in part.columns), strict=True) for t, spots in terms(said or "", None).items() for s, f in spots]
            cols = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols, (pa.binary(), pa.string(), pa.int32(), pa.int32()), strict=True)], names=["same", "t", "s", "f"])

    found = docs.select(_same(text).alias("same"), text).mapInArrow(run, "same binary, t string, s int, f int").join(told, "t").distinct()
    return found.groupBy("same").agg(F.sort_array(F.collect_list(F.struct("s", "f", "action"))).alias("terms"))


def _cleaned(said: str, base: list[tuple[str, int, int]], found: list[dict]) -> str:
    marks = [(s, e, f"[{k}]") for k, s, e in base] + [(x["s"], x["f"], "" if x["action"] == "remove" else "[term]") for x in found]
    out, at = [], 0
    for s, e, mark in sorted(marks):
        if s >= at:
            out += [said[at:s], mark]
        at = max(at, e)
    return "".join([*out, said[at:]])


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", broadcast_terms: int = 100_000, cleaned: bool = False, **thresholds) -> DataFrame:
    """One row per document: key, n_<kind>..., base, base_sha256, terms (spans that disclose an entity) and, if ``cleaned``, text.

    The cleaned text has base spans replaced by their kind, terms generalised to ``[term]`` or removed.
    """
    told = disclosing(docs, text, broadcast_terms=broadcast_terms, **thresholds)
    few = told.count() <= broadcast_terms
    actions = {r.t: r.action for r in told.collect()} if few else {}
    wanted = frozenset(actions)
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    if few:
        rows = rows.select("_key", "_text", F.lit(None).cast("array<struct<s:int,f:int,action:string>>").alias("_terms"))
    else:
        rows = rows.withColumn("_same", _same("_text")).join(places(docs, told, text), F.col("_same") == F.col("same"), "left").select("_key", "_text", F.col("terms").alias("_terms"))
    kind = rows.schema["_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in parts(b)):
            texts = [t or "" for t in part.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            names = [_joined(s) for s in base]
            if few:
                found = [sorted(({"s": s, "f": f, "action": actions[t]} for t, spots in terms(said, wanted).items() for s, f in spots), key=lambda x: x["s"]) if wanted else [] for said in texts]
            else:
                found = [x or [] for x in part.column(2).to_pylist()]
            counts = [pa.array([sum(x[0] == k for x in s) for s in base], pa.int64()) for k in KINDS]
            out = [part.column(0), *counts, pa.array(names, pa.string()), pa.array([hashlib.sha256(n.encode()).hexdigest() for n in names], pa.string()), pa.array(found, _SPOTS)]
            if cleaned:
                out.append(pa.array(map(_cleaned, texts, base, found), pa.string()))
            yield pa.RecordBatch.from_arrays(out, names=["_key", *(f"n_{k}" for k in KINDS), "base", "base_sha256", "terms", *["text"] * cleaned])

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    shape = f"_key {kind}, {counts}, base string, base_sha256 string, terms array<struct<s:int,f:int,action:string>>" + ", text string" * cleaned
    return rows.mapInArrow(run, shape).withColumnRenamed("_key", key)


def all_spans(base: Column, terms: Column) -> Column:
    """Every span as kind:start:end, base ones first."""
    more = F.transform(F.coalesce(terms, F.array().cast("array<struct<s:int,f:int,action:string>>")), lambda x: F.concat_ws(":", F.lit("term"), x["s"], x["f"]))
    return F.array_join(F.concat(F.when(base == "", F.array().cast("array<string>")).otherwise(F.array(base)), more), ",")


def sanitised(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, text) of every row, cleaned."""
    return find(docs, key, text, cleaned=True, **options).select(key, F.col("text").alias(text))


def op2(docs: DataFrame) -> DataFrame:
    return find(docs).select("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", all_spans(F.col("base"), F.col("terms")).alias("spans"))
