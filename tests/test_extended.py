"""Changes, merges, streams, time joins, frames, sketches, keys, malformed text and nested data against plain Python."""

from __future__ import annotations

import os
import random
import shutil
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starmart.operators import asof, changes, frames, intervals, quality, sketches
from starmart.sources import nested, readers
from starmart.streaming.merge import merge_snapshot
from starmart.streaming.stream import stream_load
from tests.plans import plan_of

ROWS = "k long, v string, n int"


def counted(df) -> Counter:
    return Counter(map(tuple, df.collect()))


# Changes ------------------------------------------------------------------------------


def brute_changes(before, after):
    old, new, out = Counter(before), Counter(after), Counter()
    old_keys, new_keys = {r[0] for r in before}, {r[0] for r in after}
    for row in old | new:
        copies = new[row] - old[row]
        if copies > 0:
            out["update_new" if row[0] in old_keys else "insert", copies, *row] += 1
        if copies < 0:
            out["update_old" if row[0] in new_keys else "delete", -copies, *row] += 1
    return out


def versions(seed, n=400):
    rng = random.Random(seed)

    def rows():
        return [(rng.choice([None, *range(120)]) if rng.random() < 0.6 else 1, rng.choice(["a", "b", None, ""]), rng.choice([1, None])) for _ in range(n)]

    before = rows()
    return before, [*rng.sample(before, n // 2), *rows()[: n // 3]]


def test_changes_of_multisets_with_nulls_and_a_hot_key(spark):
    before, after = versions(1)
    found = changes.row_changes(spark.createDataFrame(before, ROWS), spark.createDataFrame(after, ROWS), ["k"])
    assert counted(found) == brute_changes(before, after)
    same = changes.row_changes(spark.createDataFrame(before, ROWS), spark.createDataFrame(before[::-1], ROWS), ["k"])
    assert same.count() == 0
    none = spark.createDataFrame([], ROWS)
    assert {r["change"] for r in changes.row_changes(none, spark.createDataFrame(after, ROWS), ["k"]).collect()} == {"insert"}


@pytest.mark.parametrize("parts", [(), ("n",)])
def test_merge_reaches_the_new_version(spark, tmp_path, parts):
    path = str(tmp_path / "target")
    for seed in (1, 2):
        for rows in versions(seed):
            merge_snapshot(spark, spark.createDataFrame(rows, ROWS), key=["k"], target_path=path, partition_by=parts)
            assert counted(spark.read.schema(ROWS).parquet(path).select("k", "v", "n")) == Counter(rows)
    again = merge_snapshot(spark, spark.createDataFrame(rows, ROWS), key=["k"], target_path=path, partition_by=parts)
    assert again == {}


def test_merge_writes_only_changed_directories_and_can_keep_missing_rows(spark, tmp_path):
    path = str(tmp_path / "target")
    rows = [(i, "a", i % 3) for i in range(9)]
    merge_snapshot(spark, spark.createDataFrame(rows, ROWS), key=["k"], target_path=path, partition_by=("n",))
    before = {d: sorted(os.listdir(f"{path}/{d}")) for d in ("n=0", "n=1", "n=2")}
    newer = [(0, "b", 0)]
    counts = merge_snapshot(spark, spark.createDataFrame(newer, ROWS), key=["k"], target_path=path, partition_by=("n",), delete_missing=False)
    assert counts == {"delete": 8, "update_old": 1, "update_new": 1}
    assert counted(spark.read.parquet(path).select("k", "v", "n")) == Counter([*newer, *rows[1:]])
    assert before["n=0"] != sorted(os.listdir(f"{path}/n=0")) and before["n=1"] == sorted(os.listdir(f"{path}/n=1"))
    moved = [(0, "b", 1)]
    merge_snapshot(spark, spark.createDataFrame(moved, ROWS), key=["k"], target_path=path, partition_by=("n",))
    assert counted(spark.read.parquet(path).select("k", "v", "n")) == Counter(moved)


# Stream -------------------------------------------------------------------------------

EVENT = "k long, ts timestamp, v string"


def test_stream_over_restarts_replayed_files_and_late_rows(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / x) for x in ("source", "target", "checkpoint"))
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(hours=i), "v") for i in range(300)]

    def drop(some):
        spark.createDataFrame(some, EVENT).coalesce(1).write.mode("append").parquet(source)
        return stream_load(
            spark, lambda raw: raw, lambda df: df.select("k", "ts"), source_path=source, schema=spark.createDataFrame([], EVENT).schema,
            ts="ts", delay="1 day", target_path=target, checkpoint_path=checkpoint,
        )

    assert drop([*rows[:100], rows[5], (None, None, "no time")]).late == 0
    assert drop(rows[90:200]).late == 0  # ten rows again, all within the delay
    again = drop(rows[:100])
    assert (again.read, again.late) == (100, 100)
    # At the watermark is late, just after it is not.
    edge = rows[199][1] - timedelta(days=1)
    late = drop([(900, edge, "v"), (901, edge + timedelta(seconds=1), "v"), *rows[200:]])
    assert late.late == 1
    found = sorted(r["k"] for r in spark.read.parquet(target).collect())
    assert found == [*range(300), 901]
    assert stream_load(
        spark, lambda raw: raw, lambda df: df.select("k", "ts"), source_path=source, schema=spark.createDataFrame([], EVENT).schema,
        ts="ts", delay="1 day", target_path=target, checkpoint_path=checkpoint,
    ).read == 0


def test_stream_run_again_after_a_lost_target_step(spark, tmp_path):
    """A run that broke off after its batch was planned and before it was committed writes the batch once."""
    source, target, checkpoint = (str(tmp_path / x) for x in ("source", "target", "checkpoint"))
    rows = [(i, datetime(2024, 1, 1) + timedelta(hours=i), "v") for i in range(50)]
    schema = spark.createDataFrame([], EVENT).schema

    def load():
        return stream_load(spark, lambda raw: raw, lambda df: df, source_path=source, schema=schema, ts="ts", delay="1 day", target_path=target, checkpoint_path=checkpoint)

    spark.createDataFrame(rows, EVENT).coalesce(1).write.parquet(source)
    load()
    # Without its last commit the checkpoint is that of a run that broke off; the target's log already has the batch.
    commits = sorted(int(f) for f in os.listdir(f"{checkpoint}/commits") if f.isdigit())
    shutil.move(f"{checkpoint}/commits/{commits[-1]}", str(tmp_path / "lost"))
    if os.path.exists(f"{checkpoint}/commits/.{commits[-1]}.crc"):
        shutil.move(f"{checkpoint}/commits/.{commits[-1]}.crc", str(tmp_path / "lost.crc"))
    load()
    assert sorted(r["k"] for r in spark.read.parquet(target).collect()) == list(range(50))


# Joins on time ------------------------------------------------------------------------


def brute_asof(left, right, tolerance=None):
    out = Counter()
    for row in left:
        key, ts = row[0], row[1]
        known = [r for r in right if key is not None and ts is not None and r[0] == key and r[1] is not None and r[1] <= ts]
        best = max(known, key=lambda r: (r[1], r[2]), default=None)
        if best and tolerance is not None and ts - best[1] > timedelta(seconds=tolerance):
            best = None
        out[(*row, best[2] if best else None)] += 1
    return out


@pytest.mark.parametrize("tolerance", [None, 3000])
def test_asof_with_half_of_the_rows_on_one_key(spark, tolerance):
    rng = random.Random(5)
    start = datetime(2024, 1, 1)

    def rows(n, label):
        return [
            (rng.choice([None, 1, 1, 1, 1, 2, 3, 4]), rng.choice([None, *[start + timedelta(minutes=rng.randrange(20_000)) for _ in range(30)]]), label + i)
            for i in range(n)
        ]

    left, right = rows(400, 0), rows(300, 1000)
    found = asof.asof_join(
        spark.createDataFrame(left, "k int, at timestamp, a int"), spark.createDataFrame(right, "k int, since timestamp, b int"),
        ["k"], "at", "since", ["b"], ties=["b"], tolerance_seconds=tolerance,
    )
    assert found.columns == ["k", "at", "a", "b"]
    assert counted(found) == brute_asof(left, right, tolerance)
    assert sum(r[0] == 1 for r in left) > 180


def test_asof_cells_are_dealt_by_key_and_time(spark):
    left = spark.createDataFrame([], "k int, at timestamp, a int")
    right = spark.createDataFrame([], "k int, since timestamp, b int")
    found = asof.asof_join(left, right, ["k"], "at", "since", ["b"])
    plan = plan_of(found)
    assert found.count() == 0 and "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan and "_cell" in plan
    with pytest.raises(ValueError):
        asof.asof_join(left, right.withColumnRenamed("b", "a"), ["k"], "at", "since", ["a"])


def test_overlaps_of_all_lengths(spark):
    rng = random.Random(6)

    def rows(n):
        made = []
        for i in range(n):
            low = rng.choice([None, rng.randrange(-(10**6), 10**6)])
            length = rng.choice([0, -5, 1, rng.randrange(1, 50), rng.randrange(1, 3000), rng.randrange(1, 10**6), 5 * 10**6])
            made.append((rng.choice([None, 1, 2]), i, low, None if low is None or rng.random() < 0.05 else low + length))
        return made

    left, right = rows(150), rows(150)

    def wanted(keyed):
        return Counter(
            (a[1], b[1])
            for a in left
            for b in right
            if None not in (a[2], a[3], b[2], b[3]) and a[2] < a[3] and b[2] < b[3] and a[2] < b[3] and b[2] < a[3]
            and (not keyed or a[0] is not None and a[0] == b[0])
        )

    schema = "g int, i int, low long, high long"
    mine, theirs = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    for keyed in (False, True):
        met = intervals.overlap_join(mine, theirs, ("low", "high"), ("low", "high"), ["g"] if keyed else None, base=10, levels=6)
        assert counted(met.select("left.i", "right.i")) == wanted(keyed) and wanted(keyed)
        plan = plan_of(met)
        assert "NestedLoop" not in plan and "Cartesian" not in plan


# Frames -------------------------------------------------------------------------------


def test_cube_tells_missing_values_from_totals(spark):
    df = spark.createDataFrame([("x", None, 1.1), ("x", "p", 2.2), (None, "p", 3.3)], "a string, b string, m double")
    found = {(r["a"], r["b"], r["level_id"]): (r["revenue"], r["n_rows"]) for r in frames.revenue_cube(df, ["a", "b"], "m").collect()}
    assert found[None, None, 3] == (6.6, 3) and found["x", None, 0] == (1.1, 1) and found["x", None, 1] == (3.3, 2)
    assert found[None, "p", 0] == (3.3, 1) and found[None, "p", 2] == (5.5, 2) and found[None, None, 2] == (1.1, 1) and len(found) == 8


def test_trailing_and_running_sums(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "a", "b", None]), rng.choice([None, date(2024, 1, 1) + timedelta(days=rng.randrange(60))]), i, rng.choice([None, rng.randrange(10_000) / 100])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, day date, i int, m double")
    daily = {}
    for k, day, _, m in rows:
        if day is not None:
            daily.setdefault((k, day), []).append(m)

    def total(parts):
        known = [round(m * 100) for m in parts if m is not None]
        return sum(known) / 100 if known else None

    for r in frames.trailing_sum(df, ["k"], "day", "m", 7).collect():
        days = [r["day"] - timedelta(days=d) for d in range(7)]
        assert r["revenue"] == total(daily[r["k"], r["day"]])
        assert r["trailing"] == total([m for d in days for m in daily.get((r["k"], d), [])])
    order = {}
    for k, day, i, m in sorted(rows, key=lambda r: (r[1] is not None, r[1] or date.min, r[2])):
        order.setdefault(k, []).append((i, m))
    wanted = {i: total([x or 0 for _, x in members[: at + 1]]) for members in order.values() for at, (i, _) in enumerate(members)}
    found = frames.running_total(df, ["k"], "day", ["i"], "m")
    assert found.columns == ["k", "day", "i", "m", "running"]
    assert {r["i"]: r["running"] for r in found.collect()} == wanted
    assert "_bucket" in plan_of(found)


# Sketches -----------------------------------------------------------------------------


def test_sketches_of_parts_make_that_of_the_whole(spark):
    df = spark.range(40_000).selectExpr("id % 7000 as k", "case when id % 10 = 0 then null else cast(id as double) end as v", "id")
    keys, numbers = ["k"], ["v"]
    parts = [sketches.load_sketches(df.where(f"id % 3 = {i}"), f"p{i}", keys, numbers) for i in range(3)]
    merged = sketches.sketch_report(parts[0].unionAll(parts[1]).unionAll(parts[2]))
    whole = sketches.sketch_report(sketches.load_sketches(df, "all", keys, numbers))
    found, at_once = ({r["column_name"]: r for r in x.collect()} for x in (merged, whole))
    assert found["k"]["n_distinct"] == at_once["k"]["n_distinct"] and abs(found["k"]["n_distinct"] - 7000) < 0.05 * 7000
    assert (found["v"]["n_rows"], found["v"]["n_null"]) == (40_000, 4_000) and found["k"]["p50"] is None
    for rank, name in ((0.05, "p05"), (0.5, "p50"), (0.95, "p95")):
        assert abs(found["v"][name] / 40_000 - rank) < 0.03
    empty = sketches.sketch_report(sketches.load_sketches(df.limit(0), "none", keys, numbers))
    assert {(r["column_name"], r["n_rows"], r["n_distinct"], r["p50"]) for r in empty.collect()} == {("k", 0, 0, None), ("v", 0, 0, None)}


# Keys and malformed text --------------------------------------------------------------

FK = quality.ForeignKey("child", "c", "parent", "p")


def test_orphans_and_repeated_keys(spark):
    child = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (9, 4), (9, 5), (8, 6), (None, 7)], "c int, i int")
    parent = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "p int")
    assert sorted(r["i"] for r in quality.orphans(child, parent, FK).collect()) == [4, 5, 6]
    assert sorted(r["i"] for r in quality.matched(child, parent, FK).collect()) == [1, 2, 3]
    assert tuple(quality.orphan_report(child, parent, FK).first()) == ("child", "c", "parent", 7, 1, 3, 3, 2, 9)
    assert child.join(parent, child.c == parent.p, "left").count() == 9
    assert tuple(quality.repeated_keys(parent, ["p"], "parent").first()) == ("parent", "p", 3, 1, 2, 1)
    assert tuple(quality.orphan_report(child.limit(0), parent.limit(0), FK).first())[3:] == (0,) * 6
    assert tuple(quality.repeated_keys(parent.limit(0), ["p"], "parent").first())[2:] == (0,) * 4


def test_malformed_values_are_counted_and_kept(spark):
    rows = [("1", "1.5", "2024-01-01"), ("x", "1,5", "n/a"), (" ", "", None), ("3.0", "1e3", "2024-13-01"), (None, "NaN", "2024-01-01 10:00:00"), ("99999999999", ".5", " ")]
    text = spark.createDataFrame(rows, "i string, d string, t string")
    types = {"i": "int", "d": "double", "t": "timestamp"}
    found = {r["metric_name"]: (r["metric_value"], r["example"]) for r in quality.malformed_report(text, types).collect()}
    assert found == {"malformed_i": (3, "3.0"), "malformed_d": (1, "1,5"), "malformed_t": (2, "2024-13-01")}
    both = readers.with_raw_text(text, {"i": "int", "d": "double"})
    assert both.columns == ["i", "d", "t", "i_raw", "d_raw"]
    assert [r["i"] for r in both.collect()] == [1, None, None, None, None, None] and [r["i_raw"] for r in both.collect()] == [r[0] for r in rows]


# Nested -------------------------------------------------------------------------------


def test_json_with_drift(spark):
    texts = ['{"k": 1, "tags": [" B", "a", "b", null, ""]}', '{"k": "2", "new": 1, "also": {"x": 2}}', '{"k": "no"}', "{bad", None, "[1]", '{"tags": "x"}', "{}"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, p string")
    found = nested.json_fields(df, "p", {"k": "bigint", "tags": "array<string>"}).withColumn("clean", nested.clean_labels("tags"))
    rows = {r["i"]: r for r in found.collect()}
    assert [rows[i]["k"] for i in range(8)] == [1, 2, None, None, None, None, None, None]
    assert rows[0]["clean"] == ["a", "b"] and rows[1]["extra_fields"] == ["also", "new"] and rows[0]["extra_fields"] == []
    assert [rows[i]["malformed"] for i in range(8)] == [False, False, False, True, False, False, False, False]
    assert rows[3]["extra_fields"] is None and rows[5]["extra_fields"] == []
    assert counted(nested.label_counts(found, "clean")) == {("a", 1): 1, ("b", 1): 1}
    with pytest.raises(ValueError):
        nested.json_fields(df.withColumn("k", F.lit(1)), "p", {"k": "bigint"})
