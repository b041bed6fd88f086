from __future__ import annotations

import datetime
import json
import types

import pytest
from pyspark.sql import functions as F

from lumenrec import session
from lumenrec.sources import catalog, history, snapshots, vectors


def test_unknown_tag_is_an_error():
    with pytest.raises(KeyError):
        catalog.source("nothing")


def test_only_category(frame, rows):
    df = frame("category string", ("a",), ("b",))
    assert rows(catalog.only_category(df, "all")) == [("a",), ("b",)]
    assert rows(catalog.only_category(df, "a")) == [("a",)]


def test_filter_and_columns_reach_the_scan(spark):
    from lumenrec.plans.inputs import Inputs

    inp = Inputs(spark, "/root/testdata/sf0.001")
    df = catalog.scan(inp.table("part"), ["p_partkey"], "p_size >= 40")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(p_size,40)" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in plan


def test_snapshot_rotation(spark, frame, tmp_path):
    args = (str(tmp_path), "test", "Demo", "mix/a")
    for value in (1, 2, 3):
        last = snapshots.write_snapshot(frame("x int", (value,)), *args)
    assert snapshots.read_snapshot(spark, *args).first().x == 3
    assert snapshots.read_snapshot(spark, *args, which="backup").first().x == 2
    root = snapshots.dataset_path(*args)
    assert sorted(f.name[:2] for f in (tmp_path / "test/demo/mix/a").iterdir() if f.is_dir()) == ["v-", "v-", "v-"]
    snapshots.write_snapshot(frame("x int", (3,)), *args)
    assert len([f for f in (tmp_path / "test/demo/mix/a").iterdir() if f.is_dir()]) == 3  # latest, backup, retired
    last = snapshots.write_snapshot(frame("x int", (3,)), *args)
    snapshots.write_snapshot(frame("x int", (2,)), *args)
    last = snapshots.write_snapshot(frame("x int", (3,)), *args)
    assert snapshots.read_pointer(spark, root)["latest"] == last.rsplit("/", 1)[1]
    snapshots.delete_path(spark, last)
    assert snapshots.read_newest(spark, *args).first().x == 2
    snapshots.write_snapshot(frame("x int", (4,)), *args)
    assert snapshots.read_snapshot(spark, *args).first().x == 4
    assert snapshots.read_snapshot(spark, *args, which="backup").first().x == 2


def test_a_reader_during_the_swap_sees_a_whole_pointer(spark, frame, tmp_path, monkeypatch):
    args = (str(tmp_path), "test", "demo", "d")
    root = snapshots.dataset_path(*args)
    snapshots.write_snapshot(frame("x int", (1,)), *args)
    reader = snapshots.read_snapshot(spark, *args)
    snapshots.write_snapshot(frame("x int", (2,)), *args)
    backup = snapshots.read_snapshot(spark, *args, which="backup")
    # a write that breaks off before the rename leaves the old pointer as it was
    before = snapshots.read_pointer(spark, root)
    monkeypatch.setattr(snapshots, "json", types.SimpleNamespace(dumps=lambda content: 1 / 0, loads=json.loads))
    with pytest.raises(ZeroDivisionError):
        snapshots.write_snapshot(frame("x int", (9,)), *args)
    monkeypatch.undo()
    assert snapshots.read_pointer(spark, root) == before
    snapshots.write_snapshot(frame("x int", (3,)), *args)
    assert backup.first().x == 1 and reader.first().x == 1  # files of resolved versions are still there


def test_scratch_folders_can_be_removed(spark, frame, tmp_path):
    from pathlib import Path

    kept = session.materialize(frame("a int", (1,)), "mine")
    folder = Path(kept.inputFiles()[0].removeprefix("file://")).parent
    assert folder.exists() and session.clear_scratch(spark) >= 1 and not folder.exists()


def test_one_day_is_a_range_of_the_scan(spark):
    from lumenrec.plans import catalogue

    plan = catalogue.QUERIES["daily_scores_valid"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThan" in plan


def test_missing_snapshot_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        snapshots.read_newest(spark, str(tmp_path), "test", "demo", "none")
    with pytest.raises(ValueError):
        snapshots.dataset_path(str(tmp_path), "moon", "demo", "x")


def test_days_prune_directories(spark, frame, rows, tmp_path):
    path = str(tmp_path / "days")
    df = frame(
        "x int, category string, ts timestamp_ntz",
        *[(d, "ab"[d % 2], datetime.datetime(2024, 1, d, 12)) for d in range(1, 11)],
    )
    history.write_by_day(df, "ts", path, ["category"])
    got = history.read_last_days(spark, path, "20240108", 3, ["a"])
    assert rows(got, "x") == [(6,), (8,)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(category" in plan or "PartitionFilters: [isnotnull(dt" in plan


def test_vector_lines_take_the_last_fields(frame):
    lines = frame("value string", ("id1,skip,1.5,2,3",), ("short,1",))
    got = vectors.parse_vector_lines(lines, 3).collect()
    assert [(r.item_id, r.vector) for r in got] == [("id1", [1.5, 2.0, 3.0])]


def test_scratch_uses_the_configured_folder(spark):
    assert session.new_scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_spread_leaves_wide_scans_alone(spark):
    wide = spark.range(0, 100, 1, 64)
    assert session.spread(wide) is wide
    assert session.spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == 4


def test_materialize_returns_the_same_rows(spark, frame, rows):
    df = frame("a int, b string", (1, "x"), (2, None))
    back = session.materialize(df.withColumn("c", F.col("a") + 1), "t")
    assert rows(back) == [(1, "x", 2), (2, None, 3)]
