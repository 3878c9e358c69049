"""Landing records with keys that the declared schema lacks.

The reference inferred a schema for each object, so a key that is new upstream
reached it; a declared schema drops it.  Here the unknown keys of a record are
kept as EXTRAS, a map of VARIANT values, beside its typed columns.  A report
says which keys there are and of which types, and a key is promoted to a
column of its own from the stored table, without reading the landing again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from boardlake.sources.landing import CORRUPT, with_landed

EXTRAS = "extras"


def extras_of(text: Column, declared: list[str]) -> Column:
    """The keys of a JSON object that are not ``declared``, with their values as they are; null if there is none."""
    values = F.map_filter(F.from_json(text, "map<string, variant>"), lambda k, v: ~k.isin(declared))
    return F.when(F.size(values) > 0, values)


def read_json_with_extras(spark: SparkSession, path: str | list[str], schema: StructType, multi_line: bool = False,
                          keep_corrupt: bool = False, landed: bool = False) -> DataFrame:
    """The columns of ``landing.read_json`` and EXTRAS; ``multi_line`` means one object a file.

    The text is read once, and parsed for the typed columns and for the extras.
    """
    text = spark.read.text(path, wholetext=multi_line)
    text = with_landed(text) if landed else text
    fields = StructType(schema.fields + [StructField(CORRUPT, StringType())])
    record = F.from_json("value", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    names = [*schema.names, *([CORRUPT] if keep_corrupt else [])]
    rest = [c for c in text.columns if c != "value"]
    # A text that is no object is no map either, and its extras are null.
    clean = F.when(F.col("r").isNotNull() & F.col(f"r.{CORRUPT}").isNull(), extras_of(F.col("value"), schema.names))
    rows = text.where(F.trim("value") != "").select("value", record.alias("r"), *rest)
    return rows.select(*[F.col(f"r.{c}").alias(c) for c in names], *rest, clean.alias(EXTRAS))


def drift_report(rows: DataFrame) -> DataFrame:
    """(key, n, type) of every key in the EXTRAS of ``rows``: how many records have it, and the type that holds all its values."""
    each = rows.select(F.explode(EXTRAS).alias("key", "value"))
    return each.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.schema_of_variant_agg("value").alias("type"))


def promote(rows: DataFrame, key: str, kind: str, path: str = "$", name: str | None = None) -> DataFrame:
    """``rows`` with the extra ``key`` (or the ``path`` inside it) as a column of type ``kind``; null where it can't be cast."""
    return rows.withColumn(name or key, F.try_variant_get(F.try_element_at(EXTRAS, F.lit(key)), path, kind))
