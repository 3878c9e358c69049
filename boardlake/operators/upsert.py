"""Keyed upsert without MERGE.

Semantics of ``MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *``
with schema evolution on:

* matched key: every shared column takes the source value, nulls included;
* source-only key: inserted;
* target-only key: kept as is (there is no delete clause);
* null keys never match, so they are inserted;
* a column only in the source is added (null for rows it does not touch),
  a column only in the target keeps its value on update and is null on insert.

The plan is named by a parameter, never chosen by size: ``shuffle`` (the
default) is one full outer join on the key, ``stream_target`` streams the
target past a stored source that its measured size proves small.  See :func:`upsert`.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardlake.operators.dedupe import latest_per_key
from boardlake.session import checkpoint_root

PLANS = ("shuffle", "stream_target")
#: Bytes that a source broadcast by ``stream_target`` may have: of its files, and of its rows as JSON text, which no compression hides.
MAX_SOURCE_FILE_BYTES, MAX_SOURCE_BYTES = 16 << 20, 64 << 20

_T = "t__"
_S = "s__"
_SEEN = "__in_source"
_HELD = "__in_target"


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


def _key_present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for k in keys:
        present = present & F.col(f"`{k}`").isNotNull()
    return present


def _checked_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df``; a null in a key declared non-null fails the job."""
    failure = F.when(~_key_present(keys), F.raise_error(F.lit("upsert: null in a key declared non-null")))
    return df.where(failure.isNull())


def _unique_keyed(source: DataFrame, keys: Sequence[str],
                  order_by: Sequence[Column | str] | None) -> DataFrame:
    """One row per key of a source whose keys are all present."""
    if order_by:
        return latest_per_key(source, list(keys), order_by)
    counted = source.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    failure = F.when(F.col("__n") > 1,
                     F.raise_error(F.concat(F.lit("upsert: source repeats key "),
                                            F.to_json(F.struct(*[F.col(k) for k in keys])))))
    # A filter (not a dropped column) so that column pruning cannot remove the check.
    return counted.where(failure.isNull()).drop("__n")


def unique_source(source: DataFrame, keys: Sequence[str],
                  order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """One source row per non-null key, and every row with a null key.

    With ``order_by`` the first row under that order wins (put a unique
    column last so a retried task picks the same row).  Without it a
    repeated non-null key fails the job (as MERGE does when two source rows
    match one target row).  Null-key rows take no part in either.
    """
    present = _key_present(keys)
    keyed = _unique_keyed(source.where(present), keys, order_by)
    return keyed.unionByName(source.where(~present))


def _project(t_schema, s_schema, take_source: Column, target_present: bool = True) -> list[Column]:
    """Output columns of the merged row from the prefixed target/source columns.

    Target columns first (shared ones take the source value when
    ``take_source``), then source-only columns.  ``target_present=False``
    builds rows that have no target side (pure inserts).
    """
    t_cols = [f.name for f in t_schema.fields]
    s_types = {f.name: f.dataType for f in s_schema.fields}
    out = []
    for f in t_schema.fields:
        c = f.name
        t_c = F.col(_T + c) if target_present else F.lit(None).cast(f.dataType)
        if c in s_types:
            s_c = F.col(_S + c)
            if s_types[c] != f.dataType:
                s_c = s_c.cast(f.dataType)
            out.append(F.when(take_source, s_c).otherwise(t_c).alias(c))
        else:
            out.append(t_c.alias(c))
    for f in s_schema.fields:
        if f.name not in t_cols:
            out.append(F.when(take_source, F.col(_S + f.name)).alias(f.name))
    return out


def _take_source(keep_newer: str | None) -> Column:
    """True where the merged row takes the source side."""
    take = F.col(_SEEN).isNotNull()
    if keep_newer:
        t, s = F.col(_T + keep_newer), F.col(_S + keep_newer)
        # A dated stored row is newer than an older and than an undated source row.
        target_newer = t.isNotNull() & (s.isNull() | (t > s))
        take = take & ~(F.col(_HELD).isNotNull() & target_newer)
    return take


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str] = ("id",),
           order_by: Sequence[Column | str] | None = None,
           keep_newer: str | None = None, plan: str = "shuffle",
           keys_not_null: bool = False) -> DataFrame:
    """Return the target table after upserting ``source`` on ``keys``.

    ``keep_newer`` names a timestamp column: a matched row keeps its target
    version when the target's value is strictly newer, or when the source
    has none (late or undated data does not overwrite dated state).

    ``keys_not_null=True`` declares that no key is null on either side (as
    bronze, which rejects such rows, guarantees for every pipeline table):
    then the tables are read once.  Otherwise rows with a null key, which
    never match, pass by the join in a branch of their own, however many
    there are; a null that breaks the declaration fails the job.

    Two plans give the same rows.  ``shuffle``: both sides are dealt out by
    key once for a full outer join; the uniqueness check of the source
    shares that exchange.  ``stream_target``, for a small batch and a large
    table: the source is written to the cluster's checkpoint folder, and if
    its measured rows hold at most MAX_SOURCE_BYTES it is broadcast while the
    target is only streamed -- one left outer join for kept and updated
    rows, and a semi join on the key columns for the matched keys.  A larger
    source, or a session without that folder, gets the ``shuffle`` plan.
    """
    if plan not in PLANS:
        raise ValueError(f"plan must be one of {PLANS}, got {plan!r}")
    keys = list(keys)
    t_cols, s_cols = target.columns, source.columns
    if keep_newer and (keep_newer not in t_cols or keep_newer not in s_cols):
        raise ValueError(f"keep_newer column {keep_newer!r} must exist on both sides")
    t_schema, s_schema = target.schema, source.schema
    present = _key_present(keys)
    t_keyed = _checked_keys(target, keys) if keys_not_null else target.where(present)
    s_keyed = _checked_keys(source, keys) if keys_not_null else source.where(present)
    src = _unique_keyed(s_keyed, keys, order_by)
    small = _stored_small(src) if plan == "stream_target" else None
    if small is not None:
        out = _upsert_streamed(t_keyed, small, keys, keep_newer, t_schema, s_schema)
    else:
        t = _prefixed(t_keyed, _T).withColumn(_HELD, F.lit(True))
        s = _prefixed(src, _S).withColumn(_SEEN, F.lit(True))
        joined = t.join(s, on=[t[_T + k] == s[_S + k] for k in keys], how="full_outer")
        out = joined.select(*_project(t_schema, s_schema, _take_source(keep_newer)))
    if keys_not_null:
        return out
    held = _widened(target.where(~present), t_schema, s_schema)
    inserted = _prefixed(source.where(~present), _S).select(*_project(t_schema, s_schema, F.lit(True), target_present=False))
    return out.unionByName(held).unionByName(inserted)


def _widened(target: DataFrame, t_schema, s_schema) -> DataFrame:
    """Target rows under the merged schema: source-only columns are null."""
    have = {f.name for f in t_schema.fields}
    return target.select(*[F.col(f"`{f.name}`") for f in t_schema.fields],
                         *[F.lit(None).cast(f.dataType).alias(f.name) for f in s_schema.fields if f.name not in have])


def _stored_small(src: DataFrame) -> DataFrame | None:
    """``src`` written to the checkpoint folder, if its files prove it small."""
    spark = src.sparkSession
    try:
        root = checkpoint_root(spark)
    except ValueError:
        return None
    path = f"{root}/boardlake/upsert-source-{uuid.uuid4().hex}"
    src.write.parquet(path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.getContentSummary(target).getLength() > MAX_SOURCE_FILE_BYTES:
        return None
    small = spark.read.schema(src.schema).parquet(path)
    size = small.agg(F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in src.columns]))))).first()[0]
    return small if (size or 0) <= MAX_SOURCE_BYTES else None


def _upsert_streamed(target: DataFrame, src: DataFrame, keys: list[str],
                     keep_newer: str | None, t_schema, s_schema) -> DataFrame:
    t = _prefixed(target, _T).withColumn(_HELD, F.lit(True))
    s = F.broadcast(_prefixed(src, _S).withColumn(_SEEN, F.lit(True)))
    cond = [t[_T + k] == s[_S + k] for k in keys]
    kept_or_updated = (t.join(s, on=cond, how="left")
                       .select(*_project(t_schema, s_schema, _take_source(keep_newer))))
    # Source keys that exist in the target: a semi join that reads only the
    # target's key columns; at most one row per source key.
    src_keys = F.broadcast(src.select(*[F.col(f"`{k}`") for k in keys]))
    matched = target.select(*[F.col(f"`{k}`") for k in keys]).join(src_keys, on=keys, how="left_semi")
    # Deduplicated, the matched keys are a subset of the source keys, so the
    # source's proven bound holds for them too.
    matched = F.broadcast(matched.dropDuplicates(keys))
    inserts = _prefixed(src.join(matched, on=keys, how="left_anti"), _S)
    inserted = inserts.select(*_project(t_schema, s_schema, F.lit(True), target_present=False))
    return kept_or_updated.unionByName(inserted)


def empty_like(spark, schema) -> DataFrame:
    """An empty table of ``schema`` (the target of a first upsert)."""
    return spark.createDataFrame([], schema)
