"""Versioned folders: readers, rewrites that fail, merges, high-water marks, zone maps."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from rows import same_rows

from millrace.scratch import fresh_path
from millrace.sinks import versions
from millrace.sources.files import table

SCHEMA = "k bigint, part string, v double, at timestamp_ntz"


def day(n):
    return datetime(2024, 1, 1) + timedelta(days=n)


def stored(spark, rows):
    path = fresh_path(spark, "rows")
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def made(spark, tmp_path, rows, **more):
    root = str(tmp_path / "table")
    versions.create(stored(spark, rows), root, ["part", "k"], **more)
    return root


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


ROWS = [(i, "ab"[i % 2], i / 2, day(i)) for i in range(40)]


def test_readers_keep_their_version(spark, tmp_path):
    root = made(spark, tmp_path, ROWS, cluster_by=["part"], files=4)
    old = versions.read(spark, versions.version(spark, root))
    files = set(old.inputFiles())
    new = versions.rewrite(spark, root, {"part": ("a", "a")}, ["k"], files=3)
    assert versions.versions(spark, root) == [1, 2]
    assert rows_of(old) == rows_of(versions.read(spark, new)) == sorted(ROWS, key=repr)
    assert set(old.inputFiles()) == files
    kept = files & set(versions.read(spark, new).inputFiles())
    assert kept and kept != files


def test_a_rewrite_that_dies_leaves_no_trace(spark, tmp_path, monkeypatch):
    root = made(spark, tmp_path, ROWS, files=3)
    before = versions.version(spark, root)
    for step in ("zorder_rewrite", "_listed", "commit", "_publish"):
        with monkeypatch.context() as patched:
            def die(*args, **kwargs):
                raise RuntimeError("killed")

            patched.setattr(versions, step, die)
            with pytest.raises(RuntimeError, match="killed"):
                versions.rewrite(spark, root, {"k": (None, 1000)}, ["v"])
        assert versions.version(spark, root) == before
        assert rows_of(versions.read(spark, versions.version(spark, root))) == sorted(ROWS, key=repr)
    after = versions.rewrite(spark, root, {"k": (None, 1000)}, ["v"])
    assert after.number == 2 and rows_of(versions.read(spark, after)) == sorted(ROWS, key=repr)


def test_only_one_writer_makes_a_version(spark, tmp_path):
    root = made(spark, tmp_path, ROWS)
    at = versions.version(spark, root)
    changes = stored(spark, [(1, "b", 9.0, day(99))])
    first = versions.merge(spark, at, changes, ["k"], "at")
    with pytest.raises(versions.Conflict):
        versions.merge(spark, at, stored(spark, [(2, "a", 8.0, day(99))]), ["k"], "at")
    assert versions.version(spark, root) == first


def test_merge_touches_few_files(spark, tmp_path):
    root = made(spark, tmp_path, [(i, "a", 0.0, day(0)) for i in range(8000)], cluster_by=["k"], files=8)
    at = versions.version(spark, root)
    changes = stored(spark, [(3, "a", 1.0, day(1)), (5, "a", 1.0, day(1)), (9000, "a", 1.0, day(1))])
    new = versions.merge(spark, at, changes, ["k"], "at")
    before, after = (
        {r["file"] for r in versions.manifest(spark, v).collect()} for v in (at, new)
    )
    assert len(before) == 8 and len(before & after) == 7
    result = versions.read(spark, new)
    assert result.count() == 8001
    assert rows_of(result.where("v = 1").select("k")) == [(3,), (5,), (9000,)]


def test_last_writer_wins(spark, tmp_path):
    root = made(spark, tmp_path, [(1, "a", 1.0, day(5)), (2, "a", 1.0, day(5)), (3, "a", 1.0, None)])
    at = versions.version(spark, root)
    changes = stored(
        spark,
        [
            (1, "a", 7.0, day(4)),  # older than what is there
            (2, "a", 2.0, day(6)), (2, "a", 3.0, day(8)), (2, "a", 4.0, day(7)), (2, "a", 3.0, day(8)),
            (3, "a", 5.0, day(1)), (4, "a", 6.0, None),
        ],
    )
    expected = [(1, "a", 1.0, day(5)), (2, "a", 3.0, day(8)), (3, "a", 5.0, day(1)), (4, "a", 6.0, None)]
    once = versions.merge(spark, at, changes, ["k"], "at")
    assert rows_of(versions.read(spark, once)) == expected
    twice = versions.merge(spark, once, changes, ["k"], "at")
    assert rows_of(versions.read(spark, twice)) == expected
    assert versions.merge(spark, twice, changes.limit(0), ["k"], "at") == twice
    with pytest.raises(ValueError, match="without a key"):
        versions.merge(spark, twice, stored(spark, [(None, "a", 1.0, day(1))]), ["k"], "at")


def test_pulls_follow_the_mark(spark, tmp_path):
    root, asked = str(tmp_path / "pulled"), []
    now = list(ROWS)

    def source(since):
        asked.append(since)
        return stored(spark, [r for r in now if since is None or (r[3] is not None and r[3] > since)])

    def pull():
        return versions.pull(spark, root, source, ["k"], "at", overlap=timedelta(days=2))

    now.append((77, "a", 0.0, None))
    assert rows_of(versions.read(spark, pull())) == sorted(now, key=repr)
    # One row changes, one is new, and one comes late with a time before the mark.
    now[4] = (4, "b", -1.0, day(50))
    now += [(100, "a", 1.0, day(51)), (101, "a", 1.0, day(38))]
    assert rows_of(versions.read(spark, pull())) == sorted(now, key=repr)
    last = versions.version(spark, root)
    assert rows_of(versions.read(spark, pull())) == sorted(now, key=repr)
    assert asked == [None, day(39) - timedelta(days=2), day(51) - timedelta(days=2)]
    assert last.state == {"mark": day(51).isoformat()}


def test_a_failed_pull_is_simply_run_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "pulled")
    now = stored(spark, ROWS)
    source = lambda since: now if since is None else now.where(F.col("at") > F.lit(since))
    versions.pull(spark, root, lambda since: source(since).where("k < 20"), ["k"], "at")
    with monkeypatch.context() as patched:
        patched.setattr(versions, "_publish", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            versions.pull(spark, root, source, ["k"], "at")
    assert versions.version(spark, root).state == {"mark": day(19).isoformat()}
    assert rows_of(versions.read(spark, versions.pull(spark, root, source, ["k"], "at"))) == sorted(ROWS, key=repr)


def test_zone_maps_leave_files_unopened(spark, folder, tmp_path):
    root = str(tmp_path / "zoned")
    lines = table(spark, folder, "lineitem")
    at = versions.create(lines, root, ["l_partkey", "l_suppkey"], files=16)
    for ranges in ({"l_partkey": (500, 520)}, {"l_suppkey": (None, 3)}, {"l_partkey": (1990, None), "l_suppkey": (90, 95)}):
        result = versions.read(spark, at, ranges)
        wanted = lines
        for name, (low, high) in ranges.items():
            wanted = wanted.where(F.col(name) >= low) if low is not None else wanted
            wanted = wanted.where(F.col(name) <= high) if high is not None else wanted
        same_rows(result, wanted)
        opened = result.select(F.col("_metadata.file_path")).distinct().count()
        assert opened <= len(result.inputFiles()) <= 10
    assert versions.read(spark, at, {"l_partkey": (10**9, None)}).count() == 0
    same_rows(versions.read(spark, at), lines)
    with pytest.raises(ValueError, match="zone"):
        versions.read(spark, at, {"l_tax": (0, 1)})


def test_nulls_and_no_rows(spark, tmp_path):
    rows = [(None, None, 1.0, None), (1, "a", 1.0, day(0)), (2, None, 2.0, day(1))]
    root = made(spark, tmp_path, rows, files=2)
    at = versions.rewrite(spark, root, {"part": ("a", "a")}, ["k"])
    assert rows_of(versions.read(spark, at)) == sorted(rows, key=repr)
    empty = str(tmp_path / "empty")
    nothing = versions.create(stored(spark, []), empty, ["part"])
    assert versions.read(spark, nothing).count() == 0
    grown = versions.merge(spark, nothing, stored(spark, ROWS), ["k"], "at")
    assert rows_of(versions.read(spark, grown)) == sorted(ROWS, key=repr)
    assert versions.version(spark, str(tmp_path / "absent")) is None
