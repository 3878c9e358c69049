"""Landing-zone readers.

Raw objects land as JSON (one object per line, or one per file with
``multi_line=True``).  Schemas are declared, never inferred: unknown keys
are ignored and missing keys read as null.  Timestamp text is parsed once
here with ``try_to_timestamp``, so unparseable text becomes null instead of
failing a later comparison under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from boardlake.functions.dates import parse_timestamp_text
from boardlake.schemas import (BOARDS_JSON, CARD_COLUMNS, CARD_TIMESTAMP_FIELDS, CARDS_JSON,
                               LISTS_JSON, MEMBER_COLUMNS, MEMBERS_JSON)


CORRUPT = "_corrupt_record"
#: Fields of a row whose text could not be read: (field, raw) of each.
FAILURES = "__cast_failures"


def read_json(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False,
              keep_corrupt: bool = False) -> DataFrame:
    """Read JSON with a declared schema.  ``keep_corrupt`` adds a
    ``_corrupt_record`` column holding the raw text of malformed records
    (whose fields are all null), so they can be kept rather than lost."""
    if keep_corrupt:
        schema = StructType(schema.fields + [StructField(CORRUPT, StringType())])
    reader = spark.read.schema(schema).option("multiLine", multi_line)
    if keep_corrupt:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path)


def _typed_cards(raw: DataFrame, failures: bool = False) -> DataFrame:
    """Card columns with parsed timestamps; ``failures`` adds the FAILURES array.

    Unreadable text is null in its column and kept, with the field's name, in
    the array, in the same pass that parses it.
    """
    cols, failed = [], []
    for c in CARD_COLUMNS:
        text, parsed = F.col(f"`{c}`"), parse_timestamp_text(c)
        cols.append(parsed.alias(c) if c in CARD_TIMESTAMP_FIELDS else text)
        if c in CARD_TIMESTAMP_FIELDS:
            failed.append(F.when(text.isNotNull() & parsed.isNull(), F.struct(F.lit(c).alias("field"), text.alias("raw"))))
    cols += [F.col(c) for c in (CORRUPT, *LANDED, "extras") if c in raw.columns]
    return raw.select(*cols, *([F.array_compact(F.array(*failed)).alias(FAILURES)] if failures else []))


def read_cards(spark: SparkSession, path: str, multi_line: bool = False,
               keep_corrupt: bool = False, landed: bool = False, failures: bool = False,
               extras: bool = False) -> DataFrame:
    """Bronze card rows (12 columns, plus ``_corrupt_record`` with
    ``keep_corrupt``, the LANDED columns with ``landed``, FAILURES with
    ``failures`` and unknown keys with ``extras``) from a landing directory of
    card JSON."""
    return _typed_cards(_raw(spark, path, CARDS_JSON, multi_line, keep_corrupt, landed, extras), failures)


def _raw(spark: SparkSession, path: str, schema: StructType, multi_line: bool, keep_corrupt: bool, landed: bool,
         extras: bool) -> DataFrame:
    if extras:
        from boardlake.sources.drift import read_json_with_extras
        return read_json_with_extras(spark, path, schema, multi_line, keep_corrupt, landed)
    raw = read_json(spark, path, schema, multi_line, keep_corrupt)
    return with_landed(raw) if landed else raw


def read_members(spark: SparkSession, path: str, multi_line: bool = False,
                 keep_corrupt: bool = False, landed: bool = False, extras: bool = False) -> DataFrame:
    """Bronze member rows (9 columns, plus the same options as :func:`read_cards`)."""
    raw = _raw(spark, path, MEMBERS_JSON, multi_line, keep_corrupt, landed, extras)
    return raw.select(*MEMBER_COLUMNS, *[c for c in (CORRUPT, *LANDED, "extras") if c in raw.columns])


def read_boards(spark: SparkSession, path: str, multi_line: bool = False,
                keep_corrupt: bool = False, landed: bool = False) -> DataFrame:
    """Board listing ``(id, name, pos)``, plus the same extras as :func:`read_cards`."""
    raw = read_json(spark, path, BOARDS_JSON, multi_line, keep_corrupt)
    return with_landed(raw) if landed else raw


def read_lists(spark: SparkSession, path: str, multi_line: bool = False,
               keep_corrupt: bool = False, landed: bool = False) -> DataFrame:
    """List listing ``(id, idBoard, name, pos)``, plus the same extras as :func:`read_cards`."""
    raw = read_json(spark, path, LISTS_JSON, multi_line, keep_corrupt)
    return with_landed(raw) if landed else raw


def parse_boards_column(df: DataFrame, column: str | Column) -> DataFrame:
    """Board rows from a column of board JSON text."""
    c = F.col(column) if isinstance(column, str) else column
    return df.select(F.from_json(c, BOARDS_JSON).alias("__b")).select("__b.*")


def parse_lists_column(df: DataFrame, column: str | Column) -> DataFrame:
    """List rows from a column of list JSON text."""
    c = F.col(column) if isinstance(column, str) else column
    return df.select(F.from_json(c, LISTS_JSON).alias("__l")).select("__l.*")


# Where a landed record came from: the time and path of its file, the place of
# its split in the file, and its place in the split.
LANDED = ["__landed_at", "__landed_file", "__landed_block", "__landed_row"]


def with_landed(raw: DataFrame) -> DataFrame:
    """``raw``, as read from files, with the LANDED columns.

    Of two records, the later landed one has the greater
    ``(LANDED...)`` tuple; a retried task gives a record the same one.
    """
    m = F.col("_metadata")
    return raw.withColumns({
        "__landed_at": m["file_modification_time"], "__landed_file": m["file_path"],
        "__landed_block": m["file_block_start"], "__landed_row": F.monotonically_increasing_id()})


def newest_landed() -> list[Column]:
    """Sort order that puts the last landed record first."""
    return [F.col(c).desc() for c in LANDED]


def parse_cards_column(df: DataFrame, column: str | Column, failures: bool = False) -> DataFrame:
    """Card rows from a column of card JSON text (e.g. a message payload); FAILURES too with ``failures``."""
    c = F.col(column) if isinstance(column, str) else column
    return _typed_cards(df.select(F.from_json(c, CARDS_JSON).alias("__card")).select("__card.*"), failures)


def cast_failures(rows: DataFrame) -> DataFrame:
    """(id, field, raw) of every field of ``rows`` that could not be read."""
    return rows.select("id", F.explode(FAILURES).alias("f")).select("id", "f.field", "f.raw")


def parse_members_column(df: DataFrame, column: str | Column) -> DataFrame:
    """Member rows from a column of member JSON text."""
    c = F.col(column) if isinstance(column, str) else column
    return df.select(F.from_json(c, MEMBERS_JSON).alias("__m")).select("__m.*").select(*MEMBER_COLUMNS)


def parse_json_field(column: str | Column, ddl: str) -> Column:
    """Parse a JSON text column with a DDL schema, e.g. ``'k bigint'``."""
    c = F.col(column) if isinstance(column, str) else column
    return F.from_json(c, ddl)
