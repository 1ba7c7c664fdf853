import pytest
from pyspark.sql import functions as F

from factspan.functions import geo, json, text, time
from factspan.plans import vocabulary


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("raw, want", [(" 12 ", "12"), ("'67620002", "67620002"), (" ' 7 ", "7"), ("''7", "'7"), ("\t 7\n", "7"), ("", ""), (None, None)])
def test_canonical_identifier(spark, raw, want):
    assert one(spark, text.canonical_identifier(F.lit(raw).cast("string"))) == want


@pytest.mark.parametrize("raw, want", [(None, "blank"), (" \t", "blank"), ("'", "blank"), ("12??", "placeholder"), ("12", None)])
def test_unresolvable(spark, raw, want):
    assert one(spark, text.unresolvable_reason(F.lit(raw).cast("string"))) == want


def test_media_type_and_ids(spark):
    assert one(spark, text.media_type(F.lit("Text/HTML; charset=utf-8"))) == "text/html"
    assert one(spark, text.media_type(F.lit(None).cast("string"))) == "application/octet-stream"
    d = "ab" * 32
    assert one(spark, text.object_key(F.lit(d))) == f"sha256/ab/{d}"
    assert one(spark, text.snapshot_id(F.lit("s"), F.lit(d))) == f"s:sha256:{d}"
    assert one(spark, text.is_uuid(text.derived_id(F.lit("a"), F.lit(None).cast("string"))))
    assert one(spark, text.derived_id(F.lit("a"), F.lit("b"))) != one(spark, text.derived_id(F.lit("ab"), F.lit("")))


def test_json_compares_by_meaning(spark):
    assert one(spark, json.same(F.lit('{"a":1.0,"b":[2]}'), F.lit('{ "b": [2], "a": 1 }')))
    assert not one(spark, json.same(F.lit('{"a":1}'), F.lit('{"a":2}')))
    codes = vocabulary.REFUSAL_CODES
    ok = lambda s: one(spark, json.codes_valid(F.lit(s), codes))
    assert ok('[{"code":"RIGHTS_BLOCKED"}]') and ok("[]")
    assert not ok('[{"code":"NOPE"}]') and not ok('{"code":"RIGHTS_BLOCKED"}') and not ok('[{"stage":"L8"}]') and not ok("nonsense")
    assert one(spark, json.has_code(F.lit('[{"code":"X"}]'), "X")) and not one(spark, json.has_code(F.lit("[]"), "X"))
    assert json.payload_text({"b": 1, "a": "é"}) == '{"a": "\\u00e9", "b": 1}'


def test_dates(spark):
    assert str(one(spark, time.issue_date(F.lit("1/2/2026 3:04:05 PM")))) == "2026-01-02"
    with pytest.raises(Exception):
        one(spark, time.issue_date(F.lit("2026-01-02")))
    assert not one(spark, time.stale(F.current_date(), F.lit("2001-01-01").cast("date"), F.lit(None).cast("int")))


def test_enumerations_order_by_position_not_by_alphabet(spark):
    c = F.col("c")
    df = spark.createDataFrame([(x,) for x in ("low", "high", "medium", None)], "c string")
    assert [r.c for r in df.orderBy(vocabulary.ordinal("confidence_level", c).asc_nulls_last()).collect()] == ["high", "medium", "low", None]


SQUARE = [[[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]], [[1.0, 1.0], [3.0, 1.0], [3.0, 3.0], [1.0, 3.0], [1.0, 1.0]]]]


@pytest.mark.parametrize("x, y, want", [(0.5, 0.5, True), (2.0, 2.0, False), (0.0, 2.0, False), (4.0, 4.0, False), (1.0, 2.0, False), (5.0, 2.0, False), (3.5, 3.9, True)])
def test_contains_excludes_boundary_and_holes(spark, x, y, want):
    df = spark.createDataFrame([(SQUARE,)], f"g {geo.MULTIPOLYGON}")
    assert df.select(geo.contains(geo.edges(F.col("g")), F.lit(x), F.lit(y)).alias("x")).first().x is want


def test_centroid_bounds_and_validity(spark):
    bow = [[[[0.0, 0.0], [2.0, 2.0], [2.0, 0.0], [0.0, 2.0], [0.0, 0.0]]]]
    flat = [[[[1.0, 1.0], [3.0, 3.0], [1.0, 1.0]]]]
    open_ = [[[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0]]]]
    df = spark.createDataFrame([(1, SQUARE), (2, bow), (3, flat), (4, open_), (5, [])], f"k int, g {geo.MULTIPOLYGON}")
    assert {r.k: r.f for r in df.select("k", geo.validity_fault(F.col("g")).alias("f")).collect()} == {1: None, 2: "self_intersection", 3: "too_few_points", 4: "ring_not_closed", 5: "empty"}
    r = df.where("k = 1").select(geo.centroid(F.col("g")).alias("c"), geo.bounds(F.col("g")).alias("b")).first()
    assert (tuple(r.b)) == (0.0, 0.0, 4.0, 4.0) and abs(r.c.x - 1.8333) < 0.2
    shape = spark.createDataFrame([("Polygon", "[[[0,0],[1,0],[1,1],[0,0]]]"), ("MultiPolygon", "[[[[0,0],[1,0],[1,1],[0,0]]]]"), ("Point", "[0,0]")], "k string, c string")
    assert [r.n for r in shape.select(F.size(geo.multipolygon(F.col("k"), F.col("c"))).alias("n")).collect()] in ([1, 1, None], [1, 1, -1])
