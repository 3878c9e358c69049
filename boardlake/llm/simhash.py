"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are 64-bit.  Two fingerprints within ``max_bits`` (3) differing
bits agree on at least one of ``max_bits + 1`` bit blocks, so each distinct
fingerprint goes to one bucket per block.  A bucket is one top node of the
index: its mask is the block, its pattern the value all members share there.
Inside a bucket the fingerprints are sorted by the Gray rank of their other
bits, which puts similar codes side by side; runs of neighbours form nodes
that keep the mask and pattern of the bits all of them share.  A search walks
pairs of nodes from the top and drops a pair, with everything below it, once
the bits known on both sides already differ too often.

A bucket of more than ``bucket_max`` fingerprints is split by the same rule on
its remaining bits, as often as needed; buckets shrink at every split because
distinct codes must differ in the bits that are left.  Only spanning links of
a bucket leave its task, never all its pairs.

Defined results: a null text counts as empty; a text without words has
fingerprint zero and links like any other; a null doc_id is never a
component_id unless a component holds no other id; repeated rows come back
as often as they came in (``simhash_dedup`` keeps one of them); very long texts
are hashed SHINGLES_AT_ONCE shingles at a time; extra columns are ignored, and
kept by ``simhash_dedup``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlake.llm.common import components, free_name, pick, sql_name, stored, with_fields

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Fingerprints one bucket may hold before it is split by further bits.
BUCKET_MAX = 65_536
#: Children per index node.
FANOUT = 8
#: Rows gathered before whole buckets are joined, and node pairs expanded at once.
ROWS_AT_ONCE, PAIRS_AT_ONCE = 200_000, 40_000
#: Shingles hashed at once, so that a very long text is never held as a list of shingles.
SHINGLES_AT_ONCE = 200_000

BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the unsigned 64-bit ``hashes`` set each bit (little end first)."""
    octets = hashes.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
    if len(octets) < 400:
        return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.concatenate([np.bincount(octets[:, k], minlength=256) @ BITS_OF_BYTE for k in range(8)])


def fingerprint(text: str | None, words_per_shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of a whole text; see the module docstring for the edge cases."""
    # On bytes, lower() touches A-Z only and split() cuts at [\x20\x09-\x0D] only.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    width = min(words_per_shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - width + 1]
    ends = ends[width - 1:]
    counts = np.zeros(64, np.int64)
    for k in range(0, len(starts), SHINGLES_AT_ONCE):
        spans = zip(starts[k:k + SHINGLES_AT_ONCE].tolist(), ends[k:k + SHINGLES_AT_ONCE].tolist())
        counts += bit_counts(np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64))
    return int.from_bytes(np.packbits(counts * 2 > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(*keep, fp) for every row of ``docs``; ``fp`` holds the 64 bits as a signed long."""
    rows = pick(docs, text="text", **{c: c for c in keep})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            found = np.array([fingerprint(t.as_py(), words_per_shingle) for t in texts], np.uint64)
            yield pa.record_batch([*(batch.column(c) for c in keep), pa.array(found.view(np.int64))], [*keep, "fp"])

    return rows.mapInArrow(run, with_fields(rows, "fp long", ("text",)))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def gray_code(ranks: np.ndarray) -> np.ndarray:
    return ranks ^ (ranks >> np.uint64(1))


def sub_masks(mask: int, blocks: int) -> list[int]:
    """``mask`` extended by each of ``blocks`` even blocks of the bits it lacks."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(free) * k // blocks for k in range(blocks + 1)]
    return [mask | sum(1 << b for b in free[cuts[k]:cuts[k + 1]]) for k in range(blocks)]


def _flatten(parents: np.ndarray, hi: np.ndarray) -> None:
    """Point ``hi`` nodes at their roots."""
    while True:
        up = parents[parents[hi]]
        if np.array_equal(up, parents[hi]):
            return
        parents[hi] = up


def unite(parents: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of the sets of ``a[i]`` and ``b[i]``; roots are the smallest members."""
    while len(a):
        _flatten(parents, a)
        _flatten(parents, b)
        ra, rb = parents[a], parents[b]
        apart = ra != rb
        a, b = ra[apart], rb[apart]
        np.minimum.at(parents, np.maximum(a, b), np.minimum(a, b))


def index_levels(bucket: np.ndarray, codes: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Levels of the index from the codes up: (mask, pattern, first child, children, bucket).

    ``bucket`` ascends and codes lie in Gray order inside a bucket.  A node
    covers up to FANOUT neighbours of one bucket; the top level has one node
    for each bucket.
    """
    full = np.full(len(codes), np.uint64(0xFFFFFFFFFFFFFFFF))
    levels = [(full, codes, None, None, bucket)]
    while True:
        mask, pattern, _, _, owner = levels[-1]
        change = np.concatenate([[True], owner[1:] != owner[:-1]])
        if change.all() and len(levels) > 1:
            return levels
        begin = np.flatnonzero(change)
        place = np.arange(len(owner)) - np.repeat(begin, np.diff(np.append(begin, len(owner))))
        first = np.flatnonzero(place % FANOUT == 0)
        every, some = np.bitwise_and.reduceat(pattern, first), np.bitwise_or.reduceat(pattern, first)
        shared = np.bitwise_and.reduceat(mask, first) & ~(every ^ some)
        levels.append((shared, every & shared, first, np.diff(np.append(first, len(owner))), owner[first]))


def spanning_links(bucket: np.ndarray, codes: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links (i, j) that connect, within each bucket, all codes within ``max_bits`` bits."""
    parents = np.arange(len(codes))
    levels = index_levels(bucket, codes)
    roots = np.arange(len(levels[-1][0]))
    work = [(len(levels) - 1, roots, roots)]
    while work:
        depth, a, b = work.pop()
        if len(a) > PAIRS_AT_ONCE:
            work += [(depth, a[PAIRS_AT_ONCE:], b[PAIRS_AT_ONCE:])]
            a, b = a[:PAIRS_AT_ONCE], b[:PAIRS_AT_ONCE]
        _, _, first, size, _ = levels[depth]
        mask, pattern = levels[depth - 1][:2]
        per = size[a] * size[b]
        pair = np.repeat(np.arange(len(a)), per)
        step = np.arange(len(pair)) - np.repeat(np.cumsum(per) - per, per)
        i = first[a][pair] + step // size[b][pair]
        j = first[b][pair] + step % size[b][pair]
        known = (pattern[i] ^ pattern[j]) & mask[i] & mask[j]
        near = (np.bitwise_count(known) <= max_bits) & (i < j if depth == 1 else i <= j)
        i, j = i[near], j[near]
        if depth == 1:
            unite(parents, i, j)
        elif len(i):
            work.append((depth - 1, i, j))
    every = np.arange(len(codes))
    _flatten(parents, every)
    linked = np.flatnonzero(parents != every)
    return linked, parents[linked]


def _bucket_rows(codes: np.ndarray, masks: np.ndarray) -> pa.RecordBatch:
    rank = gray_rank(codes & ~masks)
    return pa.record_batch([pa.array(x.view(np.int64)) for x in (masks, codes & masks, rank)],
                           ["mask", "pattern", "rank"])


def _u64(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).view(np.uint64)


BUCKET_SCHEMA = "mask long, pattern long, rank long"


def _buckets(codes: DataFrame, blocks: int) -> DataFrame:
    """Each fingerprint in the bucket of each of its blocks."""
    masks = sub_masks(0, blocks)

    def run(batches):
        for batch in batches:
            code = _u64(batch, "fp")
            for mask in masks:
                yield _bucket_rows(code, np.full(len(code), np.uint64(mask)))

    return codes.mapInArrow(run, BUCKET_SCHEMA)


def _split(rows: DataFrame, blocks: int) -> DataFrame:
    """The same bucket rows, each in the narrower buckets of its remaining bits."""
    def run(batches):
        for batch in batches:
            masks = _u64(batch, "mask")
            code = gray_code(_u64(batch, "rank")) & ~masks | _u64(batch, "pattern")
            for mask in np.unique(masks):
                at = masks == mask
                for finer in sub_masks(int(mask), blocks):
                    yield _bucket_rows(code[at], np.full(int(at.sum()), np.uint64(finer)))

    return rows.mapInArrow(run, BUCKET_SCHEMA)


def _join_sorted(rows: DataFrame, max_bits: int) -> DataFrame:
    """Spanning links (u, v) of each bucket; buckets are whole and sorted in their partition."""
    def join(mask, pattern, rank):
        new = np.concatenate([[True], (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])])
        bucket = np.cumsum(new)
        shared = np.bincount(bucket)[bucket] > 1
        if not shared.any():
            return None
        code = (gray_code(rank) & ~mask | pattern)[shared]
        a, b = spanning_links(bucket[shared], code, max_bits)
        return pa.record_batch([pa.array(code[a].view(np.int64)), pa.array(code[b].view(np.int64))], ["u", "v"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(tuple(_u64(batch, c) for c in ("mask", "pattern", "rank")))
            size += batch.num_rows
            if size < ROWS_AT_ONCE:
                continue
            mask, pattern, rank = (np.concatenate(x) for x in zip(*held))
            begins = np.flatnonzero((mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1]))
            cut = begins[-1] + 1 if len(begins) else 0
            if cut and (out := join(mask[:cut], pattern[:cut], rank[:cut])) is not None:
                yield out
            held, size = [(mask[cut:], pattern[cut:], rank[cut:])], len(mask) - cut
        if size and (out := join(*(np.concatenate(x) for x in zip(*held)))) is not None:
            yield out

    keyed = rows.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern", "rank")
    return keyed.mapInArrow(run, "u long, v long")


def near_links(codes: DataFrame, max_bits: int = MAX_BITS, bucket_max: int = BUCKET_MAX) -> DataFrame:
    """Links (u, v) whose components are those of all pairs of ``codes(fp)`` within ``max_bits`` bits."""
    rows, blocks = _buckets(codes.select("fp").distinct(), max_bits + 1), max_bits + 1
    done = None
    while True:
        full = stored(rows.groupBy("mask", "pattern").count().where(F.col("count") > bucket_max), "full-buckets")
        if full.isEmpty():
            ready = rows
        else:
            key = ["mask", "pattern"]
            ready = rows.join(full, key, "left_anti").select("mask", "pattern", "rank")
            rows = stored(_split(rows.join(full, key, "left_semi").select("mask", "pattern", "rank"), blocks), "buckets")
        links = _join_sorted(ready, max_bits)
        done = links if done is None else done.union(links)
        if ready is rows:
            return done


def _tagged(docs: DataFrame, keep: tuple[str, ...], words_per_shingle: int, max_bits: int, bucket_max: int) -> DataFrame:
    """(*keep, fp, component) for every row of ``docs``; ``component`` is the smallest fingerprint reachable."""
    fps = stored(fingerprints(docs, words_per_shingle, keep), "fingerprints")
    comps = components(near_links(fps, max_bits, bucket_max), "simhash-components")
    return fps.join(comps, fps.fp == comps.node, "left").select(*keep, "fp", F.coalesce("component", "fp").alias("component"))


def simhash_components(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                       bucket_max: int = BUCKET_MAX) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs(doc_id, text)``."""
    tagged = _tagged(docs, ("doc_id",), words_per_shingle, max_bits, bucket_max)
    # Stored, so that the join deals both sides itself and can split a component of very many rows.
    least = stored(tagged.groupBy("component").agg(F.min("doc_id").alias("component_id")), "simhash-least")
    return tagged.join(least, "component").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                  bucket_max: int = BUCKET_MAX) -> DataFrame:
    """One row of each component stays, with all its columns: that of the smallest doc_id.

    Rows without a doc_id come after all others; of rows that share their id
    the one of the smaller text hash stays, and of rows that share their text
    too, the first by their other columns.
    """
    hashes = [F.xxhash64("text"), F.xxhash64("text", F.lit(7))]
    key = [free_name(docs, n) for n in ("__text_hash", "__text_hash2")]
    keyed = docs.withColumns(dict(zip(key, hashes)))
    tagged = _tagged(keyed, ("doc_id", *key), words_per_shingle, max_bits, bucket_max)
    each = tagged.groupBy("component", "doc_id", *key).agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *key, "n")).alias("s")
    stay = stored(each.groupBy("component").agg(first).select(
        *[F.col(f"s.{c}").alias(f"__stay_{k}") for k, c in enumerate(("doc_id", *key, "n"))]), "simhash-stay")

    def rows_of(chosen: DataFrame) -> DataFrame:
        match = F.col("doc_id").eqNullSafe(F.col("__stay_0"))
        for k, c in enumerate(key):
            match = match & F.col(c).eqNullSafe(F.col(f"__stay_{k + 1}"))
        return keyed.join(chosen, match, "left_semi")

    out = rows_of(stay.where("__stay_3 = 1"))
    again = stay.where("__stay_3 > 1")
    if not again.isEmpty():
        # Rows that agree in id and text; a partial limit leaves one of them a task before the shuffle.
        rest = [c for c in docs.columns if c not in ("doc_id", "text") and not isinstance(docs.schema[c].dataType, T.MapType)]
        order = F.xxhash64(*[F.col(sql_name(c)) for c in rest]) if rest else F.lit(0)
        number = free_name(docs, "__number")
        numbered = rows_of(again).withColumn(number, F.row_number().over(Window.partitionBy("doc_id", *key).orderBy(order)))
        out = out.unionByName(numbered.where(F.col(number) == 1).drop(number))
    return out.drop(*key)
