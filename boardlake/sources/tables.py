"""Versioned table snapshots on any Hadoop-compatible file system.

Spark cannot overwrite a Parquet path it is reading, and an upsert reads
the table it replaces.  So every write goes to a new directory
``<root>/<name>/version=<n>`` and readers take the newest version that has
a ``_SUCCESS`` marker.  A write that dies half way leaves no marker and is
never read; task retries after a lost executor are handled by Spark's
commit protocol.  Single writer per table is assumed.

A table can be cut into buckets by a hash of some columns.  A version then
holds only the buckets it rewrote, ``version=<n>/__bucket_<N>=<b>/``, and readers
take each bucket from the newest version that has it, back to the last full
one.  So a small batch writes its buckets alone, a write that dies half way
leaves all old rows, and a filter on the bucket prunes folders.

Beside snapshots there are logs: a table of parts ``<root>/<name>/part=<key>``
that are each written whole, so writing a part again (a replayed batch)
changes nothing, and earlier parts stay.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from boardlake.sources.scratch import CODEC, broadcast_if_small, stored
from boardlake.sources.widening import common_type, widened

_PREFIX = "version="
_PART = "part="
#: Folder names of buckets, with their number; markers of a version that holds a whole table, and of a bucket left empty.
_BUCKET, _FULL, _EMPTY = "__bucket_", "_FULL", "_EMPTY_"
BUCKET = "__bucket"


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs_and_path(spark, path)
    fs.delete(p, True)


def _folders(spark: SparkSession, root: str, name: str, prefix: str) -> list[str]:
    """Names after ``prefix`` of the table's folders."""
    fs, base = _fs_and_path(spark, table_path(root, name))
    if not fs.exists(base):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(base) if st.isDirectory()]
    return [n[len(prefix):] for n in names if n.startswith(prefix)]


def _committed(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path + "/_SUCCESS")
    return fs.exists(p)


def _versions(spark: SparkSession, root: str, name: str) -> list[int]:
    return sorted(int(v) for v in _folders(spark, root, name, _PREFIX) if v.isdigit())


def committed_versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """Versions of ``name`` whose write completed, ascending (one look-up per version kept)."""
    return [v for v in _versions(spark, root, name) if _committed(spark, version_path(root, name, v))]


def list_tables(spark: SparkSession, root: str) -> list[str]:
    """Names of the snapshot tables under ``root`` (folders holding versions)."""
    fs, base = _fs_and_path(spark, root.rstrip("/"))
    if not fs.exists(base):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(base)
                  if st.isDirectory() and latest_version(spark, root, st.getPath().getName()) is not None)


def version_path(root: str, name: str, version: int) -> str:
    return f"{table_path(root, name)}/{_PREFIX}{version:08d}"


def latest_version(spark: SparkSession, root: str, name: str) -> int | None:
    """Number of the newest committed version of ``name``; None when absent.

    Looks from the newest folder down, so it takes one look-up however many
    versions are kept, unless writes have failed.
    """
    for v in reversed(_versions(spark, root, name)):
        if _committed(spark, version_path(root, name, v)):
            return v
    return None


def bucket_of(columns: list[str | Column], n: int) -> Column:
    """Bucket, from 0 to ``n - 1``, of a row."""
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_and_path(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)]


def bucket_count(spark: SparkSession, root: str, name: str, version: int | None = None) -> int | None:
    """Into how many buckets table ``name`` is cut; None when it is not, or absent."""
    version = latest_version(spark, root, name) if version is None else version
    if version is None:
        return None
    found = [x for x in _names(spark, version_path(root, name, version)) if x.startswith((_BUCKET, _EMPTY))]
    if not found:
        return None
    # Both names carry the count: __bucket_64=5 and _EMPTY_64_5.
    first = found[0]
    return int(first[len(_BUCKET):].split("=")[0] if first.startswith(_BUCKET) else first[len(_EMPTY):].split("_")[0])


def bucket_paths(spark: SparkSession, root: str, name: str, version: int) -> dict[int, str]:
    """Folder of each bucket of a bucketed table at ``version``, those written last first."""
    n, found, seen = bucket_count(spark, root, name, version), {}, set()
    for v in reversed([v for v in committed_versions(spark, root, name) if v <= version]):
        path = version_path(root, name, v)
        names = _names(spark, path)
        here = {int(x.split("=")[1]): f"{path}/{x}" for x in names if x.startswith(f"{_BUCKET}{n}=")}
        found.update({b: p for b, p in sorted(here.items()) if b not in seen})
        seen.update(here, (int(x.split("_")[-1]) for x in names if x.startswith(f"{_EMPTY}{n}_")))
        if _FULL in names:
            break
    return found


def read_table(spark: SparkSession, root: str, name: str, version: int | None = None,
               keep_bucket: bool = False) -> DataFrame | None:
    """Latest committed snapshot (or ``version``); None when the table does not exist.

    ``keep_bucket`` leaves the BUCKET column of a bucketed table in place; a
    filter on it reads only the folders of its buckets.
    """
    newest = latest_version(spark, root, name)
    if newest is None:
        return None
    v = newest if version is None else version
    if v != newest and not _committed(spark, version_path(root, name, v)):
        raise ValueError(f"table {name!r} has no committed version {v}")
    n = bucket_count(spark, root, name, v)
    if n is None:
        return spark.read.parquet(version_path(root, name, v))
    paths = list(bucket_paths(spark, root, name, v).values())
    # Versions only widen the schema, so the bucket written last has all columns.
    schema = spark.read.parquet(paths[0]).schema
    full = StructType(schema.fields + [StructField(_PREFIX[:-1], IntegerType()), StructField(f"{_BUCKET}{n}", IntegerType())])
    rows = spark.read.option("basePath", table_path(root, name)).schema(full).parquet(*paths)
    own = [F.col(f"`{c}`") for c in schema.names]
    return rows.select(*own, F.col(f"{_BUCKET}{n}").alias(BUCKET)) if keep_bucket else rows.select(*own)


def widen(df: DataFrame, old_schema: StructType | None) -> DataFrame:
    """Schema-widening overwrite: keep every old column (null where the new
    data lacks it), in the old order, then append the new columns.

    A column in both gets their common type, structs field by field; types
    without one raise ``WideningError``, so no column silently changes its type.
    """
    if old_schema is None:
        return df
    new = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in old_schema.fields:
        if f.name in new:
            kind = common_type(f.dataType, new[f.name], f.name)
            cols.append(widened(F.col(f"`{f.name}`"), new[f.name], kind).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    old_names = {f.name for f in old_schema.fields}
    cols += [F.col(f"`{c}`") for c in df.columns if c not in old_names]
    return df.select(*cols)


@contextlib.contextmanager
def timestamps_with_statistics(spark: SparkSession):
    """Tables are written with timestamps in microseconds.

    Spark's default, INT96, has no minimum and maximum in the file, so a
    filter on a date would skip nothing.
    """
    key = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(key)
    spark.conf.set(key, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_snapshot(df: DataFrame, root: str, name: str, merge_schema: bool = True,
                   partition_by: list[str] | None = None,
                   cluster_by: list[str] | None = None) -> int:
    """Replace ``name`` with ``df`` as a new version; returns the version number.

    ``merge_schema`` keeps columns of the previous version that ``df``
    lacks (as nulls).  Only the schema of the previous version is read.
    ``cluster_by`` sorts each task's rows before writing (no shuffle), so
    Parquet row-group statistics let later filters on those columns skip
    data.
    """
    spark = df.sparkSession
    newest = latest_version(spark, root, name)
    if merge_schema and newest is not None:
        df = widen(df, read_table(spark, root, name, newest).schema)
    if cluster_by:
        df = df.sortWithinPartitions(*cluster_by)
    version = 1 if newest is None else newest + 1
    writer = df.write.mode("overwrite").option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with timestamps_with_statistics(spark):
        writer.parquet(version_path(root, name, version))
    return version


def write_buckets(df: DataFrame, root: str, name: str, by: list[str], n: int, touched: list[int] | None = None,
                  cluster_by: list[str] | None = None) -> int:
    """New version of a table in ``n`` buckets by ``by``; returns the version number.

    ``touched`` names the buckets that ``df`` holds all rows of; other
    buckets stay as they are.  Without it ``df`` is the whole table.  Rows stay in
    the tasks of the merge and are not dealt out again, so a bucket has a file
    of each task that holds rows of it; AQE bounds the tasks by the size of the
    data.  The version counts once its ``_SUCCESS`` is there, which is put
    last, when all files and markers are in place.
    """
    spark, column = df.sparkSession, f"{_BUCKET}{n}"
    version = (latest_version(spark, root, name) or 0) + 1
    path = version_path(root, name, version)
    rows = df.withColumn(column, bucket_of(by, n))
    if cluster_by:
        rows = rows.sortWithinPartitions(column, *cluster_by)
    writer = rows.write.mode("overwrite").option("compression", CODEC).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    with timestamps_with_statistics(spark):
        writer.partitionBy(column).parquet(path)
    fs, folder = _fs_and_path(spark, path)
    fs.mkdirs(folder)
    written = {int(x.split("=")[1]) for x in _names(spark, path) if x.startswith(f"{column}=")}
    if not written and touched is None:  # an empty table still has a schema
        df.limit(0).coalesce(1).write.mode("overwrite").option(
            "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/{column}=0")
    empty = [f"{_EMPTY}{n}_{b}" for b in touched or () if b not in written]
    for marker in (*empty, *([_FULL] if touched is None else []), "_SUCCESS"):
        _touch(spark, f"{path}/{marker}")
    return version


def _touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs_and_path(spark, path)
    fs.create(p, True).close()


def _first_rows(source: DataFrame, keys: list[str], order_by, drop: tuple[str, ...]) -> DataFrame | None:
    """The newest row per key of a stored source, dealing out by key only the rows of repeated keys; None if those are many."""
    from boardlake.operators.dedupe import latest_per_key
    from boardlake.operators.upsert import _checked_keys
    source = _checked_keys(source, keys)
    repeated = stored(source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*keys), "repeated-keys")
    few = broadcast_if_small(repeated, keys)
    if few is repeated:
        return None
    newest = latest_per_key(source.join(few, keys, "left_semi"), keys, order_by)
    return source.join(few, keys, "left_anti").select(*source.columns).unionByName(newest).drop(*drop)


def merge_into(spark: SparkSession, root: str, name: str, source: DataFrame, keys,
               order_by=None, keep_newer: str | None = None,
               cluster_by: list[str] | None = None, plan: str = "shuffle",
               drop: tuple[str, ...] = (), buckets: tuple[list[str], int] | None = None, is_stored: bool = False) -> int:
    """Upsert ``source`` into table ``name`` and commit a new version.

    :func:`boardlake.operators.upsert.upsert` against the latest snapshot,
    written as the next one (the table is created on first use).  Keys are
    declared non-null.  ``plan`` names the upsert's plan; ``drop`` names
    source columns that ``order_by`` needs and the table does not hold.

    With ``buckets``, (columns, count), the table is cut into buckets and only
    those are read and written that hold, or get, a row of the source.
    ``is_stored`` says that the source is a stored table, cheap to read again.

    A first version of a stored source is written as it is read but for the
    rows of keys that it repeats, if those keys are few.
    """
    from boardlake.operators.dedupe import latest_per_key
    from boardlake.operators.upsert import empty_like, upsert
    keys = list(keys)
    if is_stored and order_by and latest_version(spark, root, name) is None:
        first = _first_rows(source, keys, order_by, drop)
        if first is not None:
            return write_buckets(first, root, name, *buckets, cluster_by=cluster_by) if buckets else \
                write_snapshot(first, root, name, cluster_by=cluster_by)
    if drop:
        source, order_by = latest_per_key(source, keys, order_by).drop(*drop), None
    target = read_table(spark, root, name, keep_bucket=bool(buckets))
    if buckets is None:
        target = empty_like(spark, source.schema) if target is None else target
        merged = upsert(target, source, keys, order_by=order_by, keep_newer=keep_newer, plan=plan, keys_not_null=True)
        return write_snapshot(merged, root, name, cluster_by=cluster_by)

    by, n = list(buckets[0]), buckets[1]
    if target is None or bucket_count(spark, root, name) != n:
        target = empty_like(spark, source.schema) if target is None else target.drop(BUCKET)
        merged = upsert(target, source, keys, order_by=order_by, keep_newer=keep_newer, plan=plan, keys_not_null=True)
        return write_buckets(merged, root, name, by, n, cluster_by=cluster_by)
    if order_by:
        source = latest_per_key(source, keys, order_by)
    # The batch is read three times: for its buckets, for its keys, and to be merged.
    source = source if is_stored and not order_by else stored(source, f"batch-{name}")
    touched = {r[0] for r in source.select(bucket_of(by, n)).distinct().collect()}  # ``n`` numbers at most
    if not set(by) <= set(keys) and not touched >= bucket_paths(spark, root, name, latest_version(spark, root, name)).keys():
        # A row may have moved to another bucket: those of the stored rows count too (key and bucket alone are read).
        held = target.select(BUCKET, *keys).join(source.select(*keys), keys, "left_semi")
        touched |= {r[0] for r in held.select(BUCKET).distinct().collect()}
    touched = sorted(touched)
    if not touched:
        return latest_version(spark, root, name)
    part = target.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    merged = upsert(part, source, keys, keep_newer=keep_newer, plan=plan, keys_not_null=True)
    return write_buckets(merged, root, name, by, n, touched, cluster_by)


def write_part(df: DataFrame, root: str, name: str, key: str) -> None:
    """Write part ``key`` of log ``name``, replacing only that part."""
    df.write.mode("overwrite").option("compression", CODEC).parquet(f"{table_path(root, name)}/{_PART}{key}")


def parts(spark: SparkSession, root: str, name: str) -> list[str]:
    """Keys of the committed parts of log ``name``."""
    return sorted(k for k in _folders(spark, root, name, _PART)
                  if _committed(spark, f"{table_path(root, name)}/{_PART}{k}"))


def read_parts(spark: SparkSession, root: str, name: str, keys: list[str] | None = None) -> DataFrame | None:
    """The rows of the parts ``keys`` (all, if not given); None when there is none."""
    keys = parts(spark, root, name) if keys is None else keys
    if not keys:
        return None
    return spark.read.option("mergeSchema", "true").parquet(*[f"{table_path(root, name)}/{_PART}{k}" for k in keys])


def delete_parts(spark: SparkSession, root: str, name: str, keys: list[str]) -> None:
    for k in keys:
        delete_path(spark, f"{table_path(root, name)}/{_PART}{k}")


def _version_of(bucket_path: str) -> int:
    return int(bucket_path.rsplit("/", 2)[1][len(_PREFIX):])


def prune_versions(spark: SparkSession, root: str, name: str, keep: int = 3) -> list[int]:
    """Delete all but the newest ``keep`` committed versions of ``name`` (and
    older ones of which these show buckets), and any uncommitted (failed) version directory older than the newest
    committed one.  Returns the versions deleted."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    committed = committed_versions(spark, root, name)
    if not committed:
        return []
    needed = set(committed[-keep:])
    for v in committed[-keep:]:  # and the older versions whose buckets they still show
        if bucket_count(spark, root, name, v) is not None:
            needed.update(_version_of(p) for p in bucket_paths(spark, root, name, v).values())
            needed.add(max((w for w in committed if w <= v and _FULL in _names(spark, version_path(root, name, w))), default=v))
    gone = [v for v in _versions(spark, root, name) if v not in needed and v < committed[-1]]
    for v in gone:
        delete_path(spark, version_path(root, name, v))
    return gone
