"""Exact dedup by content-defined chunk recipes, in DataFrame operations only.

Two texts are equal when they are identical after deleting the characters
``[\\x20\\x09-\\x0D]``.  The text without them is cut into chunks where its
content says so: at the first ``[.!?,;:|]`` or ideographic full stop at least
MIN_CHUNK characters into a chunk, or after MAX_CHUNK characters.  Each chunk gets an
identifier of ``width`` 64-bit hashes.  The identifiers are verified: every
distinct chunk moves once to the others of its identifier, and if two different
chunks share one, the whole run uses identifiers 64 bits wider.  After that,
a document is its recipe, the ordered list of its chunk identifiers, and only
recipes are grouped, compared and joined; the texts don't move again.

Defined results: a null text is empty, and all empty texts are one group; of
equal texts the row with the most code points in the original text stays, then
the smallest doc_id, null ids last.  Rows that repeat both the staying doc_id
and the text are all marked kept by ``chunk_dedup``; ``keep_first`` returns
one of them.  Very long texts only make longer recipes.  Columns besides
doc_id and text are never looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardlake.llm.common import free_name, pick, released_shuffles, sql_name, stored

MIN_CHUNK, MAX_CHUNK = 512, 4096
#: Hashes of 64 bits in an identifier at first.
WIDTH = 2

CHUNK_PATTERN = f"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?[.!?,;:|。]|.{{1,{MAX_CHUNK}}}"


def without_space(text: Column) -> Column:
    """The text without the characters ``[\\x20\\x09-\\x0D]``; null becomes empty."""
    out = F.coalesce(text, F.lit(""))
    for char in "\x20\x09\x0a\x0b\x0c\x0d":
        out = F.replace(out, F.lit(char), F.lit(""))
    return out


def chunks_of(norm: Column) -> Column:
    return F.regexp_extract_all(norm, F.lit(CHUNK_PATTERN), F.lit(0))


def hash64(chunk: Column, salt: int) -> Column:
    return F.xxhash64(chunk, F.lit(salt))


def identifier(chunk: Column, width: int, hasher=hash64) -> Column:
    return F.array(*[hasher(chunk, k) for k in range(width)])


def recipe_of(norm: Column, width: int, hasher=hash64) -> Column:
    """Ordered chunk identifiers of a text, ``width`` longs for each chunk."""
    return F.flatten(F.transform(chunks_of(norm), lambda c: identifier(c, width, hasher)))


def verified_width(docs: DataFrame, width: int = WIDTH, hasher=hash64) -> int:
    """The least width from ``width`` on at which no two different chunks share an identifier."""
    texts = pick(docs, text="text").select(without_space(F.col("text")).alias("norm"))
    chunks = texts.select(F.explode(chunks_of(F.col("norm"))).alias("chunk"))
    while True:
        held = chunks.select(*[hasher(F.col("chunk"), k).alias(f"id{k}") for k in range(width)], "chunk").distinct()
        shared = held.groupBy(*[f"id{k}" for k in range(width)]).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        with released_shuffles(docs.sparkSession):
            verified = shared.isEmpty()
        if verified:
            return width
        width += 1


def _narrow(docs: DataFrame, width: int, hasher) -> DataFrame:
    texts = pick(docs, doc_id="doc_id", text="text").select(
        "doc_id", F.coalesce(F.char_length("text"), F.lit(0)).alias("points"),
        without_space(F.col("text")).alias("norm"))
    return texts.select("doc_id", "points", F.sha2("norm", 256).alias("text_sha256"),
                        recipe_of(F.col("norm"), width, hasher).alias("recipe"))


def chunk_dedup(docs: DataFrame, width: int = WIDTH, hasher=hash64) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row for each row of ``docs``."""
    width = verified_width(docs, width, hasher)
    narrow = stored(_narrow(docs, width, hasher), "recipes")
    best = F.min(F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("missing"), "doc_id"))
    groups = narrow.groupBy("recipe").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    # Stored, so that the join deals both sides itself and can split a group of very many copies.
    groups = stored(groups.select("recipe", F.col("best.doc_id").alias("keep_id"), "group_size"), "recipe-groups")
    return narrow.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_first(docs: DataFrame, width: int = WIDTH, hasher=hash64) -> DataFrame:
    """The row of ``docs`` that stays of each group of equal texts, with all its columns."""
    width = verified_width(docs, width, hasher)
    mark, norm, place = (free_name(docs, n) for n in ("__recipe", "__norm", "__place"))
    keyed = docs.withColumn(norm, without_space(F.col("text"))).withColumn(
        mark, recipe_of(F.col(sql_name(norm)), width, hasher)).drop(norm)
    # The rank limit works before the shuffle, so a group of copies leaves each map task as one row.
    order = Window.partitionBy(sql_name(mark)).orderBy(
        F.char_length(F.coalesce("text", F.lit(""))).desc(), F.col("doc_id").asc_nulls_last())
    return keyed.withColumn(place, F.row_number().over(order)).where(F.col(sql_name(place)) == 1).drop(mark, place)
