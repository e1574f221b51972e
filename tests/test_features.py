"""One GeoJSON document by ranges of bytes, held against the document read whole."""

import json

import numpy as np
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from roadloom.sources import features, tables

NAMES = ["plain", 'a "quoted" name', "braces } { ] [ in it", 'ends in a backslash \\', '"features":[{', '\\"}', "", "Ünïcode ☃", '"', "}" * 40]


@pytest.fixture
def ranges(spark):
    """Sets the bytes of a range; a task takes one or several."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def cut(size: int, cost: int = 1 << 20) -> None:
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], str(cost))

    yield cut
    for n, v in zip(names, before, strict=True):
        spark.conf.set(n, v)


def collection(seed: int, count: int, **space) -> str:
    rng = np.random.default_rng(seed)

    def ring() -> list:
        return rng.integers(-50, 50, (int(rng.integers(1, 9)), 2)).tolist()

    def feature(i: int) -> dict:
        many = bool(rng.random() < 0.3)
        shape = [[ring() for _ in range(rng.integers(1, 4))] for _ in range(rng.integers(1, 3))] if many else [ring() for _ in range(rng.integers(1, 4))]
        own = {"name": NAMES[i % len(NAMES)], "note": NAMES[int(rng.integers(len(NAMES)))]} if rng.random() < 0.8 else {"features": "none"}
        return {"type": "Feature", "properties": own, "geometry": {"type": "MultiPolygon" if many else "Polygon", "coordinates": shape}}

    before = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "x"}}, "bbox": [1, 2, 3], "links": [{"properties": {"name": "no"}}, {"a": [{}]}], "about": "\"features\": [{}]"}
    after = {"more": [{"properties": {"name": "neither"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0]]]}}], "end": {"features": [{"properties": {"name": "nor"}}]}}
    return json.dumps(before | {"features": [feature(i) for i in range(count)]} | after, **space)


def rows(df) -> list:
    return sorted(tuple(r) for r in df.select("name", "file_order", "ring", "i", "x", "y").collect())


@pytest.mark.parametrize(("size", "cost", "space"), [(401, 1 << 20, {}), (900, 0, {"indent": 1}), (1024, 200, {"separators": (",", ":"), "ensure_ascii": False}), (1 << 27, 0, {})])
def test_ranges_give_the_document(size, cost, space, spark, tmp_path, ranges):
    path = str(tmp_path / "d.json")
    (tmp_path / "d.json").write_text(collection(size, 20, **space), encoding="utf-8")
    want = rows(tables.read_polygons(spark, path))
    ranges(size, cost)
    got = features.read_polygon_ranges(spark, path)
    assert len(want) > 60 and rows(got) == want
    assert rows(features.read_polygon_ranges(spark, path, exterior_only=True)) == rows(tables.read_polygons(spark, path, exterior_only=True))


def test_many_tasks_read_one_file_and_a_feature_may_fill_several(spark, tmp_path, ranges):
    long = [[i % 360 - 180, i % 170 - 85] for i in range(4000)]  # eight ranges
    shapes = [{"properties": {"name": n}, "geometry": {"type": "Polygon", "coordinates": [c]}} for n, c in (("short", long[:3]), ("long", long), ("last", long[:5]))]
    path = str(tmp_path / "d.json")
    (tmp_path / "d.json").write_text(json.dumps({"features": shapes}))
    ranges(4096)
    assert features._pieces(spark, path).rdd.getNumPartitions() > 8
    found = features.read_features(spark, path)
    assert [(r.file_order, r.n) for r in found.selectExpr("file_order", "properties['name'] AS n").orderBy("file_order").collect()] == [(0, "short"), (1, "long"), (2, "last")]
    assert rows(features.read_polygon_ranges(spark, path)) == rows(tables.read_polygons(spark, path))


def test_several_files_number_their_own_features(spark, tmp_path, ranges):
    for k in range(3):
        (tmp_path / f"{k}.json").write_text(collection(k, 12))
    ranges(1024, 100)
    found = features.read_features(spark, str(tmp_path)).select("path", "file_order").collect()
    assert sorted(r.file_order for r in found) == sorted(list(range(12)) * 3) and len({r.path for r in found}) == 3


def test_empty_and_broken_documents(spark, tmp_path, ranges):
    (tmp_path / "none.json").write_text('{"type":"FeatureCollection","features":[]}\n')
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "broken.json").write_text(collection(1, 5)[:900])
    ranges(512)
    assert features.read_features(spark, str(tmp_path / "none.json")).count() == 0
    assert features.read_features(spark, str(tmp_path / "empty.json")).count() == 0
    with pytest.raises((PySparkException, Py4JJavaError)):
        features.read_polygon_ranges(spark, str(tmp_path / "broken.json")).collect()
