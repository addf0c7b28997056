"""Versioned tables and snapshots: whole versions through faults and races."""

import datetime as dt
import os
import subprocess
import sys
import threading

import pytest
from pyspark.sql import functions as F

from airshed.session import list_folder, publish, write_text
from airshed.sources import readers, versioned
from airshed.sources.readers import read_or_build
from airshed.sources.versioned import ConcurrentWriteError, current, merge_versioned, read_table, replace_table, vacuum, versions, write_version

D = [dt.date(2024, 3, d) for d in range(1, 8)]
SCHEMA = "date date, city_id long, m double"
KEYS = ["date", "city_id"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(map(tuple, df.select("date", "city_id", "m").collect()))


def merge(spark, path, rows, **more):
    return merge_versioned(spark, path, frame(spark, rows), KEYS, created_col=None, **more)


def commits(path):
    return sorted(os.listdir(f"{path}/_data"))


def test_merges_make_versions_that_stay_readable(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    assert rows_of(merge(spark, path, [(D[0], 1, 1.0), (D[1], 1, 2.0), (D[1], 2, 3.0)])) == [(D[0], 1, 1.0), (D[1], 1, 2.0), (D[1], 2, 3.0)]
    first = read_table(spark, path)
    merge(spark, path, [(D[1], 2, 30.0), (D[2], 5, 5.0)])
    assert rows_of(read_table(spark, path)) == [(D[0], 1, 1.0), (D[1], 1, 2.0), (D[1], 2, 30.0), (D[2], 5, 5.0)]
    assert rows_of(first) == rows_of(read_table(spark, path, 1)) == [(D[0], 1, 1.0), (D[1], 1, 2.0), (D[1], 2, 3.0)]
    assert versions(spark, path) == [1, 2]
    untouched = current(spark, path).parts
    assert untouched["date=2024-03-01"] == versioned.load_version(spark, path, 1).parts["date=2024-03-01"]  # not rewritten


def test_a_merge_reads_and_writes_only_the_touched_partitions(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    merge(spark, path, [(d, c, 1.0) for d in D for c in range(5)])
    merge(spark, path, [(D[3], 2, 9.0)])
    last = current(spark, path).parts
    new = [p for p, c in last.items() if c != last["date=2024-03-01"]]
    assert new == ["date=2024-03-04"]
    plan = read_table(spark, path).filter(F.col("date") == F.lit(D[3]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024-03-04" in plan


def test_a_merge_lists_only_the_days_of_its_source(spark, tmpdir_path, monkeypatch):
    path = f"{tmpdir_path}/t"
    merge(spark, path, [(d, 1, 1.0) for d in D])
    seen = []
    real = versioned.read_version
    monkeypatch.setattr(versioned, "read_version", lambda s, p, v: (seen.append(sorted(v.parts)), real(s, p, v))[1])
    merged = merge(spark, path, [(D[2], 1, 2.0), (D[4], 1, 2.0)])
    assert seen[0] == ["date=2024-03-03", "date=2024-03-04", "date=2024-03-05"] and len(seen[1]) == 7
    assert rows_of(merged) == [(d, 1, 2.0 if d in (D[2], D[4]) else 1.0) for d in D]


class Killed(BaseException):
    pass


@pytest.mark.parametrize("step", ["data", "list", "manifest", "rename"])
def test_a_writer_that_dies_leaves_the_old_version_whole(spark, tmpdir_path, monkeypatch, step):
    path = f"{tmpdir_path}/t"
    before = rows_of(merge(spark, path, [(d, 1, 1.0) for d in D]))

    def die(*_, **__):
        raise Killed

    source = [(d, c, 2.0) for d in D for c in (1, 2)]
    if step == "data":  # some partitions are written, one task fails
        late = F.when(F.col("date") == F.lit(D[5]), F.raise_error(F.lit("disk full")).cast("double")).otherwise(F.col("m"))
        real = versioned.upsert
        monkeypatch.setattr(versioned, "upsert", lambda *a: real(*a).withColumn("m", late))
        with pytest.raises(Exception, match="disk full"):
            merge(spark, path, source)
    else:
        monkeypatch.setattr(versioned, {"list": "list_folder", "manifest": "write_text", "rename": "publish"}[step], die)
        with pytest.raises(Killed):
            if step == "list":  # the version itself is resolved by a listing
                monkeypatch.undo()
                base = current(spark, path)
                monkeypatch.setattr(versioned, "list_folder", die)
                write_version(spark, path, frame(spark, source), base)
            else:
                merge(spark, path, source)
    monkeypatch.undo()
    assert rows_of(read_table(spark, path)) == before and versions(spark, path) == [1]
    after = rows_of(merge(spark, path, source))  # a rerun succeeds
    assert after == sorted((d, c, 2.0) for d in D for c in (1, 2))


def test_a_killed_process_leaves_a_whole_version(spark, tmpdir_path):
    """kill -9 of a writing process, from its first partition on to its end."""
    path = f"{tmpdir_path}/t"
    before = rows_of(merge(spark, path, [(d, 1, 1.0) for d in D]))
    code = f"""
import sys, os, threading, time
sys.path.insert(0, {os.getcwd()!r})
from airshed.session import build_session
from airshed.sources.versioned import merge_versioned
spark = build_session("local[1]", extra={{"spark.checkpoint.dir": {tmpdir_path + "/ckpt"!r}}})
rows = [(d, c, 2.0) for d in [r[0] for r in spark.read.parquet({path + "/_data"!r}).select("date").distinct().collect()] for c in (1, 2)]
def watch():
    while True:
        for c in os.listdir({path + "/_data"!r}):
            f = {path + "/_data/"!r} + c
            if c not in {commits(path)!r} and any("date=" in d for d, _, _ in os.walk(f)):
                os.kill(os.getpid(), 9)
threading.Thread(target=watch, daemon=True).start()
merge_versioned(spark, {path!r}, spark.createDataFrame(rows, {SCHEMA!r}), ["date", "city_id"], created_col=None)
"""
    died = subprocess.run([sys.executable, "-c", code], capture_output=True, timeout=180)
    assert died.returncode == -9, died.stderr[-2000:]
    assert len(commits(path)) == 2  # it got as far as writing rows
    assert rows_of(read_table(spark, path)) == before and versions(spark, path) == [1]


def test_of_two_concurrent_writers_one_fails(spark, tmpdir_path, monkeypatch):
    path = f"{tmpdir_path}/t"
    merge(spark, path, [(D[0], 1, 1.0)])
    meet = threading.Barrier(2)
    real = versioned._publish_version

    def together(*a):
        meet.wait(60)
        real(*a)

    monkeypatch.setattr(versioned, "_publish_version", together)
    said = {}

    def write(name, city):
        try:
            merge(spark, path, [(D[1], city, float(city))])
            said[name] = "done"
        except ConcurrentWriteError:
            said[name] = "late"

    threads = [threading.Thread(target=write, args=(n, c)) for n, c in (("a", 10), ("b", 20))]
    [t.start() for t in threads]
    [t.join(120) for t in threads]
    assert sorted(said.values()) == ["done", "late"]
    won = 10 if said["a"] == "done" else 20
    assert rows_of(read_table(spark, path)) == [(D[0], 1, 1.0), (D[1], won, float(won))]
    assert versions(spark, path) == [1, 2]
    assert all(not n.startswith("_new") for n in os.listdir(f"{path}/_versions/v00000002"))


def test_a_late_writer_may_run_again(spark, tmpdir_path, monkeypatch):
    path = f"{tmpdir_path}/t"
    merge(spark, path, [(D[0], 1, 1.0)])
    real, other = versioned._publish_version, []

    def overtaken(session, where, version):
        if not other:
            other.append(1)
            merge(spark, path, [(D[1], 7, 7.0)])
        real(session, where, version)

    monkeypatch.setattr(versioned, "_publish_version", overtaken)
    merge(spark, path, [(D[1], 8, 8.0)], retries=1)
    assert rows_of(read_table(spark, path)) == [(D[0], 1, 1.0), (D[1], 7, 7.0), (D[1], 8, 8.0)]


def test_a_plain_folder_is_adopted(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    frame(spark, [(D[0], 1, 1.0), (D[1], 1, 2.0)]).write.partitionBy("date").parquet(path)
    assert rows_of(read_table(spark, path)) == [(D[0], 1, 1.0), (D[1], 1, 2.0)]
    merge(spark, path, [(D[1], 1, 20.0), (D[2], 2, 3.0)])
    assert rows_of(read_table(spark, path)) == [(D[0], 1, 1.0), (D[1], 1, 20.0), (D[2], 2, 3.0)]


def test_unpartitioned_tables_and_replacement(spark, tmpdir_path):
    path = f"{tmpdir_path}/cities"
    one = spark.createDataFrame([(1, "a"), (2, "b")], "city_id long, name string")
    merge_versioned(spark, path, one, ["city_id"], partition_col=None, created_col=None)
    merge_versioned(spark, path, spark.createDataFrame([(2, "B"), (3, "c")], one.schema), ["city_id"], partition_col=None, created_col=None)
    assert sorted(map(tuple, read_table(spark, path).collect())) == [(1, "a"), (2, "B"), (3, "c")]
    replace_table(spark, path, spark.createDataFrame([(9, "z")], one.schema), ["city_id"])
    assert [tuple(r) for r in read_table(spark, path).collect()] == [(9, "z")]


def test_empty_source_null_partition_and_wrong_layout(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    assert merge(spark, path, []).count() == 0 and read_table(spark, path).columns == ["city_id", "m", "date"]
    merge(spark, path, [(D[0], 1, 1.0)])
    assert merge(spark, path, []).count() == 1
    write_version(spark, path, frame(spark, [(None, 4, 4.0)]), current(spark, path))
    assert sorted(r["city_id"] for r in read_table(spark, path).collect()) == [1, 4]
    with pytest.raises(ValueError, match="partitioned"):
        merge(spark, path, [(D[0], 1, 1.0)], partition_col=None)
    with pytest.raises(FileNotFoundError):
        read_table(spark, f"{tmpdir_path}/none")


def test_vacuum_keeps_what_live_versions_name(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    merge(spark, path, [(D[0], 1, 1.0), (D[1], 1, 1.0)])
    merge(spark, path, [(D[1], 1, 2.0)])
    merge(spark, path, [(D[1], 1, 3.0)])
    frame(spark, [(D[2], 1, 1.0)]).write.partitionBy("date").parquet(f"{path}/_data/commit=dead")  # a writer that died
    assert vacuum(spark, path) == [f"{path}/_versions/v00000001", f"{path}/_versions/v00000002"]  # younger folders stay
    vacuum(spark, path, older_than_s=-60)
    assert len(commits(path)) == 2 and "commit=dead" not in commits(path)
    assert rows_of(read_table(spark, path)) == [(D[0], 1, 1.0), (D[1], 1, 3.0)]


# --- snapshots


def test_a_half_written_snapshot_is_rebuilt(spark, tmpdir_path):
    path = f"{tmpdir_path}/snap"
    df = spark.range(100)
    df.repartition(4).write.parquet(path)
    files = sorted(n for n in os.listdir(path) if n.startswith("part-"))
    for n in files[1:] + ["_SUCCESS"]:
        os.remove(f"{path}/{n}")
    assert read_or_build(spark, path, lambda: df).count() == 100
    assert os.listdir(tmpdir_path) == ["snap"]
    assert read_or_build(spark, path, lambda: df.limit(0)).count() == 100


def test_of_two_builders_one_snapshot_stays(spark, tmpdir_path, monkeypatch):
    path = f"{tmpdir_path}/snap"
    meet = threading.Barrier(2)
    real = readers.publish

    def together(*a):
        meet.wait(60)
        return real(*a)

    monkeypatch.setattr(readers, "publish", together)
    got = {}
    builders = [threading.Thread(target=lambda k=k: got.update({k: read_or_build(spark, path, lambda: spark.range(k, k + 10).repartition(3))})) for k in (0, 1000)]
    [t.start() for t in builders]
    [t.join(120) for t in builders]
    rows = {k: sorted(r[0] for r in df.collect()) for k, df in got.items()}
    assert rows[0] == rows[1000] and rows[0] in (list(range(10)), list(range(1000, 1010)))
    assert os.listdir(tmpdir_path) == ["snap"] and not [n for n in os.listdir(path) if n.startswith("_building")]


def test_a_builder_that_dies_leaves_nothing_to_read(spark, tmpdir_path):
    path = f"{tmpdir_path}/snap"
    with pytest.raises(Exception, match="boom"):
        read_or_build(spark, path, lambda: spark.range(10).select(F.raise_error(F.lit("boom")).cast("long").alias("id")))
    assert not os.path.exists(path)
    assert read_or_build(spark, path, lambda: spark.range(3)).count() == 3


def test_publish_never_replaces_a_folder(spark, tmpdir_path):
    for name in ("first", "second"):
        write_text(spark, f"{tmpdir_path}/_{name}/x", name)
    assert publish(spark, f"{tmpdir_path}/_first", f"{tmpdir_path}/t") and not publish(spark, f"{tmpdir_path}/_second", f"{tmpdir_path}/t")
    assert [n for n in list_folder(spark, f"{tmpdir_path}/t") if not n.startswith("_")] == ["x"]
    assert os.listdir(tmpdir_path) == ["t"]
    with pytest.raises(ValueError):
        publish(spark, f"{tmpdir_path}/t", f"{tmpdir_path}/u")
