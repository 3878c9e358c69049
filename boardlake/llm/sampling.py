"""SentencePiece segmentations drawn by forward filtering, backward sampling.

The forward pass sums the weights of all ways to cut a word into pieces; the
backward pass draws one from its end, each piece with its exact conditional
probability.  Pieces follow Zipf's law over the vocabulary's own order
(weight ``1 / (rank + ZIPF_SHIFT)``), raised to ``alpha``: a large value
draws the likeliest cut, a small one spreads.  The draws are numbered hashes
of the row's key, so a row has the same pieces in any batch, task or retry.

As the library does, a space goes before the text, and a space in a piece is
the word mark.  A word mark or a character outside the vocabulary becomes its
UTF-8 bytes, so decoding gives back every text.

Defined results: null and empty texts have no pieces and decode to an empty
text; a null key counts as the text "null"; repeated rows have the same
pieces; very long texts are drawn in groups of WORDS_AT_ONCE words, and a word
of any length whole; an empty table gives no row; all columns of the input are kept, and a clash of names is an error only for the
output names asked for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.llm.common import pick, sql_name, with_fields
from boardlake.llm.lattice import FOREIGN, WORDS, Lattice, Pieces, pieces_of, utf8_bytes, utf8_size
from boardlake.llm.token_text import text_parts

ALPHA, ZIPF_SHIFT, SEED = 1.0, 2.0, 42
#: Bytes of text drawn together, words drawn together, and draws numbered in a row for a word; further ones (long runs of spaces) go on from 2^40.
TEXT_BYTES, WORDS_AT_ONCE, DRAWS = 3 << 19, 200_000, 2048


def zipf_logp(pieces: Pieces, alpha: float = ALPHA) -> np.ndarray:
    weight = 1.0 / (pieces.ranks() + ZIPF_SHIFT)
    return alpha * np.log(weight / weight.sum())


def uniform(seeds: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Draw ``numbers[i]`` of the stream ``seeds[i]``, in [0, 1) with 30 bits."""
    x = seeds + numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(34)).astype(np.float64) * 2.0 ** -30


def draw(pieces: Pieces, logp: np.ndarray, words: list[str], seeds: np.ndarray,
         places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of all ``words`` in order, and how many each word has.

    ``seeds`` and ``places`` are the stream of each word's row and the word's
    number in it.
    """
    distinct = {w: i for i, w in enumerate(dict.fromkeys(words))}
    kind = np.fromiter(map(distinct.__getitem__, words), np.int64, len(words))
    lattice = Lattice(pieces, list(distinct))
    weights = lattice.weights(logp)
    alpha = lattice.forward(weights)
    head, tail, piece = lattice.head, lattice.tail, lattice.piece
    chance = np.exp(alpha[tail] + weights - alpha[head])
    change = np.concatenate([[True], head[1:] != head[:-1]])
    first = np.zeros(lattice.nodes, np.int64)
    first[head[change]] = np.flatnonzero(change)
    # Summed inside each node, so that no other word of the slice touches a digit; a node has ``longest`` edges at most.
    upto, begins = chance.copy(), np.flatnonzero(change)
    rank = np.arange(len(head)) - np.repeat(begins, np.diff(np.append(begins, len(head))))
    for k in range(1, int(rank.max(initial=0)) + 1):
        at = np.flatnonzero(rank == k)
        upto[at] += upto[at - 1]
    upto[np.append(change[1:], True)] = 1.0
    # Words of a kind side by side keep the look-ups close together.
    who = np.argsort(kind, kind="stable")
    node, begin = lattice.stop[kind[who]], lattice.start[kind[who]]
    owners, drawn, step = [], [], 0
    stream, number = seeds[who], places[who] * DRAWS
    while len(who):
        edge, chosen = first[node], uniform(stream, number + step % DRAWS + (step // DRAWS << 40))
        more = np.flatnonzero(upto[edge] <= chosen)
        while len(more):
            edge[more] += 1
            more = more[upto[edge[more]] <= chosen[more]]
        owners.append(who)
        drawn.append(piece[edge])
        node, step = tail[edge], step + 1
        on = node != begin
        if not on.all():
            who, node, begin, stream, number = who[on], node[on], begin[on], stream[on], number[on]
    counts = np.zeros(len(words), np.int64)
    for owner in owners:
        counts[owner] += 1
    ids, ends = np.empty(int(counts.sum()), np.int64), np.cumsum(counts)
    for k, (owner, found) in enumerate(zip(owners, drawn)):
        ids[ends[owner] - 1 - k] = found
    return _spell(pieces, ids, counts)


def _spell(pieces: Pieces, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters outside the vocabulary become their byte pieces."""
    outside = np.flatnonzero(ids < 0)
    if not len(outside):
        return ids, counts
    chars = -1 - ids[outside]
    sizes = np.ones(len(ids), np.int64)
    sizes[outside] = utf8_size(np.where(chars == FOREIGN, 0xFFFF, chars))
    starts = np.cumsum(sizes) - sizes
    out = np.repeat(ids, sizes)
    for char in np.unique(chars):
        at = starts[outside[chars == char]]
        for k, octet in enumerate(utf8_bytes(int(char))):
            out[at + k] = pieces.byte_id[octet]
    word = np.repeat(np.arange(len(counts)), counts)
    return out, np.bincount(word, weights=sizes, minlength=len(counts)).astype(np.int64)


def segment(pieces: Pieces, logp: np.ndarray, keys: list, texts: list[str | None], seed: int = SEED) -> list[np.ndarray]:
    """Piece ids of each text, drawn from its key's stream."""
    words, seeds, places, sizes, parts = [], [], [], [], []

    def flush():
        if words:
            ids, counts = draw(pieces, logp, words, np.concatenate(seeds), np.concatenate(places))
            ends = np.cumsum(counts)[np.cumsum([n for _, n in sizes]) - 1]
            for (row, _), a, b in zip(sizes, [0, *ends[:-1].tolist()], ends.tolist()):
                parts[row].append(ids[a:b])
        for held in (words, seeds, places, sizes):
            held.clear()

    for row, (key, text) in enumerate(zip(keys, texts)):
        parts.append([])
        cut = WORDS.findall(" " + text) if text else []
        name = "null" if key is None else str(key)
        stream = np.uint64(xxhash.xxh64_intdigest(name.encode("utf-8"), seed))
        for a in range(0, len(cut), WORDS_AT_ONCE):
            some = cut[a:a + WORDS_AT_ONCE]
            words += some
            seeds.append(np.full(len(some), stream))
            places.append(np.arange(a, a + len(some)))
            sizes.append((row, len(some)))
            if len(words) >= WORDS_AT_ONCE:
                flush()
    flush()
    return [np.concatenate(p) if p else np.empty(0, np.int64) for p in parts]


def decode(pieces: Pieces, ids: np.ndarray) -> str:
    """The text that ``ids`` were drawn from."""
    return pieces.decode(ids)[1:].decode("utf-8")


def sample_pieces(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", alpha: float = ALPHA,
                  seed: int = SEED, out: str = "piece_ids", check: str = "lossless") -> DataFrame:
    """All rows and columns of ``docs`` with drawn piece ids and whether they decode to the text."""
    def run(batches):
        pieces = pieces_of(model)
        logp = zipf_logp(pieces, alpha)
        for batch in batches:
            for part, texts in text_parts(batch, TEXT_BYTES, text):
                found = segment(pieces, logp, part.column(key).to_pylist(), texts, seed)
                same = [decode(pieces, ids) == (t or "") for ids, t in zip(found, texts)]
                bounds = np.cumsum([0, *map(len, found)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(found).astype(np.int32)))
                yield pa.record_batch([*part.columns, lists, pa.array(same)], [*part.schema.names, out, check])

    return docs.mapInArrow(run, with_fields(docs, f"{sql_name(out)} array<int>, {sql_name(check)} boolean"))


def decode_pieces(rows: DataFrame, model: str, ids: str = "piece_ids", out: str = "decoded") -> DataFrame:
    """All rows and columns with the text of their piece ids; null ids decode to null."""
    def run(batches):
        pieces = pieces_of(model)
        for batch in batches:
            texts = [None if x is None else decode(pieces, np.array(x, np.int64)) for x in batch.column(ids).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    return rows.mapInArrow(run, with_fields(rows, f"{sql_name(out)} string"))


def sampled_digest(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_pieces, pieces_hash, lossless) of every row of ``docs(doc_id, text)``."""
    found = sample_pieces(pick(docs, doc_id="doc_id", text="text"), model)
    return found.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"),
                        F.xxhash64("piece_ids").alias("pieces_hash"), "lossless")
