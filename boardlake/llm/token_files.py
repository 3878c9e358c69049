"""Token-id files: concatenated ids with Elias-Fano document boundaries.

A file is a run of blocks, each followed by a line feed.  A block holds whole
documents in ascending doc_id order:

    magic, id width (2 or 4 bytes), null doc_ids, shard, block, smallest doc_id, ids
    Elias-Fano sequence of doc_id - smallest (rows with a doc_id only; null ids come first)
    Elias-Fano sequence of end offsets into the id array, one for each document
    the id array, little-endian

Document ``i`` starts at ``select(i - 1)`` of its block's end offsets, which is how the
reader finds it, so no table of 64-bit offsets is stored.
Shards ascend with doc_id, blocks with their place in the shard.  Spark's own
file writer puts the blocks out, so half-written files of lost executors never
show, and any file system that Spark can write holds them.

Defined results: a null text is empty and has the end id alone; repeated
doc_ids keep one entry for each row, in the order of a hash of their texts,
then of the texts (a range of one doc_id can span shards); a document longer than BLOCK_IDS is a block
of its own; an empty table writes no block.  Columns besides doc_id and text
are ignored.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boardlake.llm.common import pick, scratch_path, stored
from boardlake.llm.elias_fano import EliasFano, encode
from boardlake.llm.token_text import IdEncoder, text_slices

MAGIC = b"TOKIDS01"
HEAD = "<8sBQIIqQQ"
#: Ids after which a block ends, and blocks after which a file does.
BLOCK_IDS, FILE_BLOCKS = 1 << 20, 16
#: Bytes of text encoded together.
TEXT_BYTES = 8 << 20


def ended(ids: np.ndarray, counts: np.ndarray, end_id: int, width: int) -> list[bytes]:
    """The documents' ids, ``width`` bytes each, every document with ``end_id`` behind it."""
    ends = np.cumsum(counts + 1)
    out = np.full(len(ids) + len(counts), end_id, f"<u{width}")
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    out[inside] = ids
    data, cuts = out.tobytes(), (ends * width).tolist()
    return [data[a:b] for a, b in zip([0, *cuts[:-1]], cuts)]


def pack_block(doc_ids: list[int | None], ids: list[bytes], width: int, shard: int, block: int) -> bytes:
    """One block; ``ids`` are the documents' id arrays, ``doc_ids`` ascend with nulls first."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    base = int(known[0]) if len(known) else 0
    body = encode((known.astype(np.uint64) - np.uint64(base % (1 << 64))).astype(np.int64))
    body += encode(np.cumsum([len(x) // width for x in ids]))
    data = b"".join(ids)
    nulls = len(doc_ids) - len(known)
    return struct.pack(HEAD, MAGIC, width, nulls, shard, block, base, len(data) // width, len(body)) + body + data


def unpack_blocks(content: bytes):
    """(shard, block, doc_ids, end offsets, id array) of each block of a file."""
    at = 0
    while at < len(content):
        magic, width, nulls, shard, block, base, n_ids, size = struct.unpack_from(HEAD, content, at)
        if magic != MAGIC:
            raise ValueError(f"no block at byte {at}")
        keys = EliasFano(content, at + struct.calcsize(HEAD))
        ends = EliasFano(content, keys.end)
        start = at + struct.calcsize(HEAD) + size
        ids = np.frombuffer(content, f"<u{width}", n_ids, start)
        doc_ids = [None] * nulls + (keys.all() + base).tolist()
        yield shard, block, doc_ids, ends.select_many(np.arange(ends.n)), ids
        at = start + n_ids * width + 1


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, block_ids: int = BLOCK_IDS) -> None:
    """Encode ``docs(doc_id, text)`` and write token files to ``path`` in ascending doc_id order."""
    def blocks(batches):
        encoder = IdEncoder(tokenizer)
        width = 2 if max(encoder.vocabulary, end_id + 1) <= 1 << 16 else 4
        shard, number, keys, held, size = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in batches:
            for part in text_slices(batch, TEXT_BYTES):
                for doc_id, data in zip(part.column("doc_id").to_pylist(), ended(*encoder.ids(part.column("text")), end_id, width)):
                    keys.append(doc_id)
                    held.append(data)
                    size += len(data) // width
                    if size >= block_ids:
                        yield pa.record_batch([pa.array([pack_block(keys, held, width, shard, number)], pa.binary())], ["value"])
                        number, keys, held, size = number + 1, [], [], 0
        if keys:
            yield pa.record_batch([pa.array([pack_block(keys, held, width, shard, number)], pa.binary())], ["value"])

    rows = pick(docs, doc_id="doc_id", text="text")
    order = [F.col("doc_id"), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    # A cast to string keeps the bytes as they are, and the text writer puts them out unchanged.
    (ordered.mapInArrow(blocks, "value binary").select(F.col("value").cast("string"))
     .write.option("maxRecordsPerFile", FILE_BLOCKS).text(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(shard, block, place, doc_id, local_start, n_tokens, ids) of each document; ids little-endian, 4 bytes each."""
    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                for shard, block, doc_ids, ends, ids in unpack_blocks(content.as_py()):
                    starts = np.concatenate([[0], ends[:-1]])
                    wide = ids.astype("<u4").tobytes()
                    yield pa.record_batch([
                        pa.array([shard] * len(ends), pa.int64()), pa.array([block] * len(ends), pa.int64()),
                        pa.array(np.arange(len(ends))), pa.array(doc_ids, pa.int64()), pa.array(starts),
                        pa.array(ends - starts),
                        pa.array([wide[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist())], pa.binary()),
                    ], ["shard", "block", "place", "doc_id", "local_start", "n_tokens", "ids"])

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "shard long, block long, place long, doc_id long, local_start long, n_tokens long, ids binary")


def document_starts(found: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from rows of ``read_token_files``.

    Offsets are summed up the shards: within a block they are stored, within
    a shard its blocks are added up, and one row for each shard is left to
    add up last.
    """
    found = stored(found.select("shard", "block", "doc_id", "local_start", "n_tokens",
                                F.crc32("ids").alias("ids_crc32")), "token-starts")
    blocks = found.groupBy("shard", "block").agg(F.sum("n_tokens").alias("n"))
    shards = blocks.groupBy("shard").agg(F.sum("n").alias("n"))

    def before(by):
        return F.coalesce(F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    in_shard = blocks.select("shard", "block", before(Window.partitionBy("shard").orderBy("block")).alias("in_shard"))
    bases = shards.select("shard", before(Window.orderBy("shard")).alias("base"))
    return found.join(in_shard.join(bases, "shard"), ["shard", "block"]).select(
        "doc_id", (F.col("base") + F.col("in_shard") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def token_file_index(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write ``docs`` as token files in the shared folder, read them back and index them."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write_token_files(docs, path, tokenizer, end_id)
    return document_starts(read_token_files(spark, path))
