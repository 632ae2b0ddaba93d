"""Folders of Parquet files whose readers see one version or another, never a mixture.

Data files are written once and never changed. A manifest, itself a small Parquet table,
lists the files of a version with the range of some columns in each (a zone map). A
version comes into being when a file with its number and the manifest's name is renamed
into place, which either happens or does not. Whoever opened an older version keeps its
files; a writer that dies leaves files that no version names.

The rename must not replace a file that is there, as on HDFS and local disks. Below the
folder: ``data``, ``manifests``, ``versions``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.joins import check_repeatable
from millrace.operators.layout import zorder_rewrite
from millrace.scratch import fresh_path

_LOW, _HIGH = "low_", "high_"
Range = tuple[Any, Any]


class Conflict(RuntimeError):
    """Somebody else made the next version first."""


@dataclass(frozen=True)
class Version:
    root: str
    number: int
    manifest: str
    schema: T.StructType
    zones: tuple[str, ...]
    state: Mapping[str, Any] = field(default_factory=dict)


# -- files and names -------------------------------------------------------------------
def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, root: str) -> list[int]:
    folder = f"{root}/versions"
    files = _files(spark, folder)
    if not files.exists(_path(spark, folder)):
        return []
    names = [status.getPath().getName() for status in files.listStatus(_path(spark, folder))]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def _publish(spark: SparkSession, root: str, number: int, text: str) -> None:
    """Write a version's file aside, then rename it to its number if that is still free."""
    aside, place = f"{root}/versions/_{uuid.uuid4().hex}", f"{root}/versions/{number:08d}.json"
    out = _files(spark, aside).create(_path(spark, aside), False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, root).toUri(), spark._jsc.hadoopConfiguration()
    )
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        context.rename(_path(spark, aside), _path(spark, place), options)
    except Py4JJavaError as error:
        if number in _numbers(spark, root):
            raise Conflict(f"version {number} of {root} is there already") from error
        raise


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the versions, oldest first."""
    return _numbers(spark, root)


def version(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """A version, the newest unless numbered; none if there is none yet."""
    known = _numbers(spark, root)
    if number is None and not known:
        return None
    number = known[-1] if number is None else number
    text = spark.read.text(f"{root}/versions/{number:08d}.json", wholetext=True).first()[0]
    told = json.loads(text)
    schema = T.StructType.fromJson(told["schema"])
    return Version(root, number, told["manifest"], schema, tuple(told["zones"]), told["state"])


# -- manifests ---------------------------------------------------------------------------
def _manifest_schema(schema: T.StructType, zones: Sequence[str]) -> T.StructType:
    fields = [T.StructField("file", T.StringType()), T.StructField("n_rows", T.LongType())]
    for zone in zones:
        fields += [T.StructField(f"{end}{zone}", schema[zone].dataType) for end in (_LOW, _HIGH)]
    return T.StructType(fields)


def manifest(spark: SparkSession, at: Version) -> DataFrame:
    """Files of a version, the rows of each, and ``low_`` and ``high_`` of its zone columns."""
    schema = _manifest_schema(at.schema, at.zones)
    return spark.read.schema(schema).parquet(f"{at.root}/{at.manifest}")


def _listed(spark: SparkSession, root: str, folder: str, schema: T.StructType, zones: Sequence[str]) -> DataFrame:
    """A manifest of the files just written to ``folder``, from one pass over the zone columns."""
    stored = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{root}/{folder}")
    name = F.concat(F.lit(f"{folder}/"), F.col("_metadata.file_name")).alias("file")
    ends = [end for z in zones for end in (F.min(z).alias(f"{_LOW}{z}"), F.max(z).alias(f"{_HIGH}{z}"))]
    return stored.groupBy(name).agg(F.count(F.lit(1)).alias("n_rows"), *ends)


def commit(
    spark: SparkSession,
    root: str,
    files: DataFrame,
    schema: T.StructType,
    zones: Sequence[str],
    after: Version | None,
    state: Mapping[str, Any] | None = None,
) -> Version:
    """Make ``files``, rows of a manifest, the version after ``after``, or raise ``Conflict``."""
    number = after.number + 1 if after else 1
    name = f"manifests/{uuid.uuid4().hex}"
    files.coalesce(1).write.parquet(f"{root}/{name}")
    told = {"manifest": name, "schema": schema.jsonValue(), "zones": list(zones), "state": dict(state or {})}
    _publish(spark, root, number, json.dumps(told))
    return Version(root, number, name, schema, tuple(zones), dict(state or {}))


def create(
    df: DataFrame,
    root: str,
    zones: Sequence[str],
    *,
    cluster_by: Sequence[str] | None = None,
    files: int | None = None,
    state: Mapping[str, Any] | None = None,
) -> Version:
    """The first version of a folder: ``df`` clustered, by its zone columns unless named.

    ``df`` must come straight from files, see ``zorder_rewrite``.
    """
    check_repeatable(df, None)
    spark, folder = df.sparkSession, f"data/{uuid.uuid4().hex}"
    zorder_rewrite(df, list(cluster_by or zones), f"{root}/{folder}", files=files)
    return commit(spark, root, _listed(spark, root, folder, df.schema, zones), df.schema, zones, None, state)


# -- reading -------------------------------------------------------------------------------
def _within(ranges: Mapping[str, Range], low: Callable[[str], Column], high: Callable[[str], Column]) -> Column:
    """Whether values from ``low`` to ``high`` can meet all ``ranges``, whose ends count; None: open."""
    tests = [F.lit(True)]
    for name, (least, most) in ranges.items():
        if least is not None:
            tests.append(high(name) >= F.lit(least))
        if most is not None:
            tests.append(low(name) <= F.lit(most))
    return reduce(lambda a, b: a & b, tests)


def touched(spark: SparkSession, at: Version, ranges: Mapping[str, Range]) -> DataFrame:
    """Rows of the manifest whose files can hold rows within ``ranges`` of zone columns."""
    unknown = set(ranges) - set(at.zones)
    if unknown:
        raise ValueError(f"no zone columns: {sorted(unknown)}")
    can = _within(ranges, lambda z: F.col(f"{_LOW}{z}"), lambda z: F.col(f"{_HIGH}{z}"))
    return manifest(spark, at).where(can)


def _open(spark: SparkSession, at: Version, files: DataFrame) -> DataFrame:
    names = [f"{at.root}/{row[0]}" for row in files.select("file").collect()]
    if not names:
        return spark.createDataFrame([], at.schema)
    return spark.read.schema(at.schema).parquet(*names)


def read(spark: SparkSession, at: Version, ranges: Mapping[str, Range] | None = None) -> DataFrame:
    """Rows of a version, or those within ``ranges``, from the files that can hold such only.

    The names of these files come to the driver, as they do whenever Spark lists a folder.
    """
    ranges = ranges or {}
    rows = _open(spark, at, touched(spark, at, ranges))
    return rows.where(_within(ranges, F.col, F.col)) if ranges else rows


# -- changing ------------------------------------------------------------------------------
def rewrite(
    spark: SparkSession,
    root: str,
    ranges: Mapping[str, Range],
    cluster_by: Sequence[str],
    *,
    files: int | None = None,
) -> Version:
    """Cluster in place the files that lie within ``ranges`` whole; others stay as they are.

    With a partition column as a zone and its value as both ends that is one partition. The
    same rows are in the version before and in the one after.
    """
    at = version(spark, root)
    if at is None:
        raise ValueError(f"{root} has no version")
    inside = reduce(
        lambda a, b: a & b,
        [_within({z: r}, lambda z: F.col(f"{_HIGH}{z}"), lambda z: F.col(f"{_LOW}{z}")) for z, r in ranges.items()],
        F.lit(True),
    )
    # A file with nulls in a zone column, or nothing else, may reach beyond: it stays.
    inside = F.coalesce(inside, F.lit(False))
    listed = manifest(spark, at)
    rows = _open(spark, at, listed.where(inside))
    folder = f"data/{uuid.uuid4().hex}"
    zorder_rewrite(rows, cluster_by, f"{root}/{folder}", files=files)
    new = _listed(spark, root, folder, at.schema, at.zones)
    return commit(spark, root, listed.where(~inside).unionByName(new), at.schema, at.zones, at, at.state)


def _newest(rows: DataFrame, key: Sequence[str], modified: str, *before: Column) -> DataFrame:
    """Per key the row that was modified last; of equal times one that its contents choose.

    Aggregated map-side, so that a key with many changes does not gather in a task.
    """
    last = F.struct(F.col(modified), *before, F.xxhash64(*rows.columns))
    whole = F.max_by(F.struct(*rows.columns), last).alias("whole")
    return rows.groupBy(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(key)]).agg(whole).select("whole.*")


def merge(
    spark: SparkSession,
    at: Version,
    changes: DataFrame,
    key: Sequence[str],
    modified: str,
    state: Mapping[str, Any] | None = None,
) -> Version:
    """The next version, in which ``changes`` replace rows of the same key modified no later.

    Only files that hold a changed key are written anew: zones of the key's first column
    leave most others unread, and a semi-join finds them among the rest. Running it again
    with the same changes gives the same rows. ``changes`` are read several times, so pass
    what has been written.
    """
    keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    least, most, bare = changes.agg(F.min(key[0]), F.max(key[0]), F.count_if(keyless)).first()
    if bare:
        raise ValueError(f"{bare} changes without a key")
    if least is None:  # no changes
        return at if state in (None, at.state) else commit(
            spark, at.root, manifest(spark, at), at.schema, at.zones, at, state
        )
    near = touched(spark, at, {key[0]: (least, most)} if key[0] in at.zones else {})
    if near.isEmpty():
        hit = near.select("file")
    else:
        name = F.substring_index("_metadata.file_path", "/data/", -1)
        placed = _open(spark, at, near).select(*key, F.concat(F.lit("data/"), name).alias("file"))
        hit = placed.join(changes.select(*key).distinct(), list(key), "left_semi").select("file").distinct()
    path = fresh_path(spark, "touched-files")
    hit.write.parquet(path)
    hit = spark.read.schema("file string").parquet(path)
    listed = manifest(spark, at)
    old = _open(spark, at, listed.join(hit, "file", "left_semi")).withColumn("_new", F.lit(0))
    new = changes.select(*at.schema.names).withColumn("_new", F.lit(1))
    merged = _newest(old.unionByName(new), key, modified, F.col("_new")).drop("_new")
    folder = f"data/{uuid.uuid4().hex}"
    merged.hint("rebalance").write.parquet(f"{at.root}/{folder}")
    added = _listed(spark, at.root, folder, at.schema, at.zones)
    kept = listed.join(hit, "file", "left_anti").select(*added.columns)
    return commit(spark, at.root, kept.unionByName(added), at.schema, at.zones, at, state or at.state)


def pull(
    spark: SparkSession,
    root: str,
    source: Callable[[datetime | None], DataFrame],
    key: Sequence[str],
    modified: str,
    *,
    overlap: timedelta = timedelta(0),
    zones: Sequence[str] | None = None,
) -> Version:
    """Bring a folder up to date with a source that says when its rows were modified.

    The first run takes all rows. Each later one asks ``source`` for those modified after
    the high-water mark, less an ``overlap`` for rows that were committed late, and merges
    them by ``key``; the last writer wins. The mark is part of the version it belongs to,
    so rows and mark change together, and a run that failed or was repeated does no harm.
    Rows without a time are taken by the first run only.
    """
    at = version(spark, root)
    mark = datetime.fromisoformat(at.state["mark"]) if at and at.state.get("mark") else None
    path = fresh_path(spark, "pulled")
    source(mark - overlap if mark else None).write.parquet(path)
    rows = spark.read.parquet(path)
    newest = rows.agg(F.max(F.col(modified).cast("timestamp_ntz"))).first()[0]
    marks = [m for m in (mark, newest) if m is not None]
    state = {"mark": max(marks).isoformat()} if marks else {}
    if at is None:
        path = fresh_path(spark, "newest")
        _newest(rows, key, modified).write.parquet(path)
        return create(spark.read.parquet(path), root, zones or [key[0]], state=state)
    return merge(spark, at, rows, key, modified, state)
