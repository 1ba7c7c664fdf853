"""Feature collections split anywhere, against reading the document whole."""

import json
import random

import pytest

from factspan.sources import geojson, snapshot


def document(rng, n):
    said = ['}', '{"type":"Feature"}', '\\', '\\"', '"', '[[', ']}', 'é😀', '\\\\"}{', "", "plain text"]
    features = []
    for k in range(n):
        name = "".join(rng.choice(said) for _ in range(rng.randint(0, 6)))
        ring = [[rng.randint(0, 9), rng.random()] for _ in range(rng.randint(0, 40))]
        body = {"properties": {"id": k, "name": rng.choice([name, None]), "more": {"a": [{"b": name}]}}, "geometry": rng.choice([None, {"type": "Polygon", "coordinates": [ring]}]), "type": "Feature"}
        features.append(dict(rng.sample(list(body.items()), 3)))
    outer = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "x}"}}, "features": features, "bbox": [1, 2], "said": '{"features":[{"type":"Feature"}]}'}
    return dict(rng.sample(list(outer.items()), 5))


@pytest.mark.parametrize("indent", [None, 1])
def test_splits_of_any_size_give_the_same_rows(spark, tmp_path, indent):
    rng = random.Random(7)
    path = tmp_path / "c.json"
    path.write_text(json.dumps(document(rng, 60), ensure_ascii=False, indent=indent))
    # the reader of whole documents orders members by their schema, this one by their names
    want = sorted(map(tuple, snapshot.read_geojson(spark, str(path), "id:int,name:string").collect()), key=repr)
    assert len(want) == 60
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (300, 5000, 10**7):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            assert sorted(map(tuple, geojson.read_collection(spark, str(path), "id:int,name:string").collect()), key=repr) == want
            assert size > 300 or geojson.split_states(spark, str(path)).count() > 40
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_several_files_empty_ones_and_broken_features(spark, tmp_path):
    (tmp_path / "a.json").write_text('﻿{"features":[{"type":"Feature","properties":{"id":1},"geometry":null},{"type":"Other"}]}\n')
    (tmp_path / "b.json").write_text('{"type":"FeatureCollection","features":[]}')
    (tmp_path / "c.json").write_text("")
    assert [tuple(r) for r in geojson.read_collection(spark, f"{tmp_path}/*.json", "id:int").collect()] == [(1, None, None)]
    (tmp_path / "d.json").write_text('{"features":[{"type":"Feature","properties":{"id":}}]}')
    with pytest.raises(Exception, match="(?i)malformed"):
        geojson.read_collection(spark, f"{tmp_path}/*.json", "id:int").collect()


def test_what_is_written_is_read(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 4).selectExpr("named_struct('id', id, 'name', concat('}\"{[\\\\', id)) properties", "'Point' geometry_type", "concat('[', id, ',1.5]') coordinates")
    geojson.write_collection(rows, f"{tmp_path}/out")
    got = geojson.read_collection(spark, f"{tmp_path}/out", "id:int,name:string").collect()
    assert sorted(tuple(r) for r in got) == [(k, f'}}"{{[\\{k}', "Point", f"[{k},1.5]") for k in range(1000)]
    assert all(len(p.read_text().splitlines()) == 1 for p in (tmp_path / "out").glob("part*"))
