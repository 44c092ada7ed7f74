"""Folders of chunks: what is written is read again, a box opens only its chunks, a failed write leaves nothing."""

import json
import os
import pathlib

import numpy as np
import pytest

from voxtile.sources import chunks

SCHEMA = "level int, channel string, vx long, vy long, vz long, value double"
LEVELS = [chunks.level_head((21, 10, 8), (8, 4, 5), (1.0, 2.0, 3.0), (5.0, 6.0, 7.0)), chunks.level_head((6, 5, 4), (4, 4, 4))]


def volume_rows(seed=4):
    rng = np.random.default_rng(seed)
    rows = []
    for level, head in enumerate(LEVELS):
        for channel in ("a", "b b"):
            image = np.where(rng.random(head["shape"]) < 0.3, rng.normal(size=head["shape"]), 0)
            rows += [(level, channel, *map(int, p), float(image[tuple(p)])) for p in np.argwhere(image)]
    return rows


def read(df):
    return sorted(tuple(r) for r in df.collect())


def test_written_and_read_again(spark, tmp_path):
    rows, path = volume_rows(), f"{tmp_path}/v"
    df = spark.createDataFrame(rows + [(0, "a", 1, 1, 1, None), (0, "a", 2, 2, 2, 0.0)], SCHEMA).repartition(7)
    chunks.write_chunks(df.where("not (level = 0 and channel = 'a' and vx = 2 and vy = 2 and vz = 2)"), path, LEVELS, ["a", "b b"])
    rows = [r for r in rows if r[:5] != (0, "a", 2, 2, 2)]
    assert read(chunks.read_chunks(spark, path)) == sorted(rows)
    assert read(chunks.read_chunks(spark, path, level=1, channel="b b")) == sorted(r for r in rows if r[:2] == (1, "b b"))
    inside = lambda r: 3 <= r[2] < 17 and 4 <= r[3] < 5 and r[4] < 100
    assert read(chunks.read_chunks(spark, path, 0, box=((3, 17), (4, 5), (-3, 100)))) == sorted(r for r in rows if r[0] == 0 and inside(r))
    assert chunks.read_chunks(spark, path, 0, "a", zeros=True).count() == 21 * 10 * 8
    assert chunks.read_chunks(spark, path, 0, "a", ((5, 5), (0, 3), (0, 3))).count() == 0
    assert chunks.matrix_of(chunks.read_head(path)["levels"][0]) == [[1.0, 0, 0, 5], [0, 2.0, 0, 6], [0, 0, 3.0, 7], [0, 0, 0, 1]]
    with pytest.raises(Exception, match="no such channel"):
        chunks.read_chunks(spark, path, channel="c").count()
    again = spark.createDataFrame([(9, 9, 7, 1.0), (9, 9, 7, 3.0), (9, 9, 7, 2.0)], "vx int, vy int, vz int, value double")
    chunks.write_chunks(again, path, LEVELS[:1], ["a"])
    assert read(chunks.read_chunks(spark, path)) == [(0, "a", 9, 9, 7, 3.0)]
    assert sorted(os.listdir(path)) == sorted([chunks.read_head(path)["data"], "head.json"]) and chunks.read_head(path)["chunks"] == 1


def test_a_box_opens_only_its_chunks(spark, tmp_path):
    rows, path = [r for r in volume_rows() if r[0] == 0], f"{tmp_path}/v"
    chunks.write_chunks(spark.createDataFrame(rows, SCHEMA), path, LEVELS, ["a", "b b"])
    for file in pathlib.Path(path).glob("data-*/*/*/*"):
        if not (file.parent.name == "1" and file.name in ("0.0.0", "0.0.1", "1.0.0", "1.0.1")):
            file.write_bytes(b"broken")
    want = sorted(r for r in rows if r[1] == "b b" and 2 < r[2] <= 10 and 1 <= r[3] < 4)
    assert read(chunks.read_chunks(spark, path, 0, "b b", ((3, 11), (1, 4), (0, 8)))) == want
    df = chunks.read_chunks(spark, path).where("level = 0 and channel in ('b b') and vx > 2 and vx <= 10 and vy >= 1 and vy < 4 and value != 0")
    assert read(df) == want
    with pytest.raises(Exception, match="decompress"):
        chunks.read_chunks(spark, path).where("vx > 2 or vy < 4").collect()


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    rows, path = volume_rows(), f"{tmp_path}/v"
    good = spark.createDataFrame(rows, SCHEMA)
    bad = good.union(spark.createDataFrame([(0, "a", 21, 0, 0, 1.0)], SCHEMA))
    with pytest.raises(Exception, match="outside"):
        chunks.write_chunks(bad, path, LEVELS, ["a", "b b"])
    assert not os.path.exists(f"{path}/head.json") and not list(pathlib.Path(path).glob("data-*"))
    chunks.write_chunks(good, path, LEVELS, ["a", "b b"])
    with pytest.raises(Exception, match="no such channel"):
        chunks.write_chunks(good, path, LEVELS, ["a"])
    assert read(chunks.read_chunks(spark, path)) == sorted(rows)  # the volume of before
    assert not [f for f in pathlib.Path(path).rglob("_*")]
    with pytest.raises(Exception, match="already"):
        chunks.write_chunks(good, path, LEVELS, ["a", "b b"], mode="append")


def test_empty_volume_has_columns(spark, tmp_path):
    path = f"{tmp_path}/v"
    chunks.write_chunks(spark.createDataFrame([], SCHEMA), path, LEVELS, ["a"])
    got = chunks.read_chunks(spark, path)
    assert got.count() == 0 and got.columns == ["level", "channel", "vx", "vy", "vz", "value"]
    with open(f"{path}/head.json") as f:
        assert json.load(f)["chunks"] == 0


def test_atlas(spark, tmp_path):
    path = f"{tmp_path}/labels"
    grid = spark.createDataFrame([(x, 0, 0, float(x % 4)) for x in range(12)], "vx long, vy long, vz long, value double")
    chunks.write_chunks(grid, path, [chunks.level_head((12, 1, 1), (4, 1, 1))], ["labels"], "<u2")
    labels = spark.createDataFrame([(0, "background"), (1, "one"), (2, "two"), (3, "three"), (9, "nine")], "index int, name string")
    voxels, table = chunks.read_atlas(spark, path, labels)
    assert voxels.count() == 9 and table is labels
    assert read(chunks.label_check(voxels, labels)) == [(1, "one", 3, True), (2, "two", 3, True), (3, "three", 3, True), (9, "nine", 0, True)]
    with pytest.raises(ValueError, match="lacks: 2, 3"):
        chunks.read_atlas(spark, path, labels.where("index not in (2, 3)"))
    assert chunks.read_atlas(spark, path, labels.where("index = 1"), strict=False, box=((0, 4), (0, 1), (0, 1)))[0].count() == 3
