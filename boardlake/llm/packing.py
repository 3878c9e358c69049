"""Best-fit packing of documents into sequences of a fixed number of tokens.

A document longer than the capacity is cut into full pieces behind a first
piece that takes the rest, so at most one piece of a document leaves room.
Pieces above a third of the capacity are large: at most two share a sequence.
They are matched greedily, the longest first, each with the longest partner
that fits, which leaves the fewest sequences two by two.  Small pieces then
fill the gaps best-fit, the longest first, each in the narrowest gap that
holds it, and open sequences of their own where no gap does.

Pieces of one length are interchangeable, so the packing is worked out on the
histogram of lengths (``capacity`` numbers at any size of the corpus).  It gives
ranges: pieces ``first`` to ``first + n`` of a length go to the sequences from
``sequence`` on, ``each`` to one, from ``offset`` on.  Every piece finds its
range by its rank among the pieces of its length: its place in its shard plus
the shards before, so no length, however common, is ever in one task.

Defined results: a null text is empty and has the end id alone; null and
repeated doc_ids are documents of their own; pieces of one length are dealt in
the order of shards, so which sequence a piece shares may differ between runs
while the sequences' lengths do not; an empty table gives no row; very long
texts are encoded whole; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boardlake.llm.common import pick, stored
from boardlake.llm.token_files import ended
from boardlake.llm.token_text import IdEncoder, text_slices

CAPACITY = 1024
#: Bytes of text encoded together.
TEXT_BYTES = 4 << 20


def pieces_of_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, shard, place, ids) of ``docs(doc_id, text)``, stored.

    ``place`` is the piece's number among those of its length in its shard;
    ``ids`` are little-endian, 4 bytes each.
    """
    rows = pick(docs, doc_id="doc_id", text="text")

    def run(batches):
        encoder, shard = IdEncoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part in text_slices(batch, TEXT_BYTES):
                ids, counts = encoder.ids(part.column("text"))
                data = ended(ids, counts, end_id, 4)
                n = counts + 1
                pieces = -(-n // capacity)
                owner = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = (n - (pieces - 1) * capacity)[owner]  # tokens of the first piece
                start = np.where(piece > 0, head + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, head)
                place = seen[length] + places_within(length)
                seen += np.bincount(length, minlength=capacity + 1)
                cut = [data[k][4 * a:4 * b] for k, a, b in zip(owner.tolist(), start.tolist(), (start + length).tolist())]
                yield pa.record_batch(
                    [part.column("doc_id").take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                     pa.array(np.full(len(owner), shard), pa.int64()), pa.array(place), pa.array(cut, pa.binary())],
                    ["doc_id", "piece", "start", "length", "shard", "place", "ids"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return stored(rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, shard long, place long, ids binary"),
                  "packing-pieces")


def places_within(values: np.ndarray) -> np.ndarray:
    """The number of equal values before each value."""
    order = np.argsort(values, kind="stable")
    new = np.flatnonzero(np.diff(values[order], prepend=-1))
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - np.repeat(new, np.diff(np.append(new, len(values))))
    return out


def plan_packing(counts: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Ranges (length, first, n, sequence, each, offset) that place ``counts[length]`` pieces of each length.

    Works on runs of alike sequences, so its time depends on the capacity, not on the pieces.
    """
    left = [int(n) for n in counts]
    placed, ranges, sequences = [0] * len(left), [], 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # room left: runs (first sequence, how many)

    def put(length, n, sequence, each, offset):
        ranges.append((length, placed[length], n, sequence, each, offset))
        placed[length] += n
        left[length] -= n

    def leave(room, sequence, n):
        if room and n:
            gaps.setdefault(room, []).append((sequence, n))

    third = capacity // 3  # a sequence holds two pieces at most of the lengths above it
    for length in range(capacity, third, -1):
        while left[length]:
            fits = range(min(length, capacity - length), third, -1)
            partner = next((p for p in fits if left[p] > (p == length)), 0)
            n = left[length]
            if partner == length:
                n //= 2
                put(length, 2 * n, sequences, 2, 0)
            else:
                n = min(n, left[partner]) if partner else n
                put(length, n, sequences, 1, 0)
                if partner:
                    put(partner, n, sequences, 1, length)
            leave(capacity - length - partner, sequences, n)
            sequences += n

    for length in range(third, 0, -1):
        rooms = sorted(room for room in gaps if room >= length)
        while left[length] and rooms:
            room = rooms[0]
            runs, each = gaps[room], room // length
            sequence, n = runs.pop()
            if not runs:
                del gaps[room]
                rooms.pop(0)
            full = min(n, left[length] // each)
            offset = capacity - room
            if full:
                put(length, full * each, sequence, each, offset)
                leave(room - each * length, sequence, full)
            rest = left[length] if full < n else 0
            if rest:
                put(length, rest, sequence + full, rest, offset)
                leave(room - rest * length, sequence + full, 1)
            leave(room, sequence + full + (1 if rest else 0), n - full - (1 if rest else 0))
        if left[length]:
            each = capacity // length
            full, rest = divmod(left[length], each)
            if full:
                put(length, full * each, sequences, each, 0)
                leave(capacity - each * length, sequences, full)
                sequences += full
            if rest:
                put(length, rest, sequences, rest, 0)
                leave(capacity - rest * length, sequences, 1)
                sequences += 1
    return np.array(ranges, np.int64).reshape(-1, 6)


def placements(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` of ``pieces_of_documents`` with (sequence_id, offset).

    The histogram of lengths, ``capacity`` rows at most, is all that the driver reads.
    """
    per_shard = stored(pieces.groupBy("shard", "length").agg(F.count(F.lit(1)).alias("n")), "packing-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for row in per_shard.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    ranges = plan_packing(counts, capacity)
    ranges = ranges[np.lexsort((ranges[:, 1], ranges[:, 0]))]
    begins = np.concatenate([[0], np.cumsum(counts)])[ranges[:, 0]] + ranges[:, 1]
    bases = np.concatenate([[0], np.cumsum(counts)])[:-1]
    shared = pieces.sparkSession.sparkContext.broadcast((ranges, begins, bases))
    earlier = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = stored(per_shard.select("shard", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "packing-before")
    ranked = pieces.join(before, ["shard", "length"]).withColumn("place", F.col("before") + F.col("place")).drop("before", "shard")

    def run(batches):
        ranges, begins, bases = shared.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("place").to_numpy()
            at = np.searchsorted(begins, bases[length] + rank, side="right") - 1
            _, first, _, sequence, each, offset = ranges[at].T
            row = rank - first
            keep = [c for c in batch.schema.names if c != "place"]
            yield pa.record_batch([*(batch.column(c) for c in keep), pa.array(sequence + row // each), pa.array(offset + row % each * length)],
                                  [*keep, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != "place")
    return ranked.mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """(length, doc_id, piece, start, ids_crc32, sequence_id, offset) of each piece of ``docs(doc_id, text)``."""
    pieces = pieces_of_documents(docs, tokenizer, end_id, capacity)
    return placements(pieces.select("doc_id", "piece", "start", "length", "shard", "place", F.crc32("ids").alias("ids_crc32")), capacity)


def packed_sequences(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids, pieces) of each sequence: its ids, 4 bytes each, and (doc_id, piece, start, length, offset) of its pieces."""
    placed = placements(pieces_of_documents(docs, tokenizer, end_id, capacity), capacity)
    # At most ``capacity`` pieces with ``capacity`` ids in all share a sequence.
    members = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "start", "length", "ids")),
                           lambda a, b: (a["offset"] - b["offset"]).cast("int"))
    found = placed.groupBy("sequence_id").agg(members.alias("m"))
    ids = F.aggregate("m", F.lit(b"").cast("binary"), lambda acc, m: F.concat(acc, m["ids"]))
    return found.select("sequence_id", ids.alias("ids"), F.transform(
        "m", lambda m: F.struct(m["doc_id"].alias("doc_id"), m["piece"].alias("piece"), m["start"].alias("start"),
                                m["length"].alias("length"), m["offset"].alias("offset"))).alias("pieces"))
