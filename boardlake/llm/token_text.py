"""Encoding text by a tokenizer file through a cache of its pre-token runs.

The byte-level and word tokenizers here never let a token cross a place where
white space follows a character that is no white space, and
neither their normalisers nor their look-ahead see across it.  So a text is
cut at all such places, each distinct piece is encoded once by the library,
and the text's tokens are those of its pieces in order.  Very long texts are
cut the same way, so no call ever gets more than ENCODE_BYTES at once unless
one piece alone is longer.

``IdEncoder`` does the same for byte-level tokenizers on Arrow's own buffers:
it cuts bytes, lets Arrow number the distinct pieces of a slice, looks only
these up, and gathers the ids of all pieces at once, so no text becomes a
Python string.
"""

from __future__ import annotations

import itertools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from boardlake.llm.common import worker_cache

#: White space as the tokenizers' pattern \\s has it (fixed values).
SPACE = " \\t\\n\\r\\x0b\\x0c\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PIECE = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: Pieces a worker remembers before it drops those not at hand, and characters given to the library at once.
CACHE_PIECES, ENCODE_BYTES = 400_000, 1 << 20
#: Longer pieces are not remembered.
CACHED_CHARS = 64


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class PieceEncoder:
    """Maps pieces to ``value(ids)``, remembering the frequent ones.

    The memory outlasts a task in its worker process; when it is full, the
    pieces of the texts at hand stay, among which are all frequent ones.
    ``name`` tells one ``value`` from another.
    """

    def __init__(self, path: str, value, name: str):
        self.tokenizer = worker_cache(("tokenizer", path), lambda: load_tokenizer(path))
        self.value, self.known = value, worker_cache(("pieces", path, name), dict)

    def _encode(self, pieces: list[str]) -> None:
        at = 0
        while at < len(pieces):
            end, size = at, 0
            while end < len(pieces) and (end == at or size + len(pieces[end]) <= ENCODE_BYTES):
                size += len(pieces[end])
                end += 1
            found = self.tokenizer.encode_batch_fast(pieces[at:end], add_special_tokens=False)
            self.known.update(zip(pieces[at:end], (self.value(e.ids) for e in found)))
            at = end

    def values(self, texts: list[str | None]) -> list[list]:
        """The values of each text's pieces, in order."""
        cut = [PIECE.findall(t) if t else [] for t in texts]
        distinct = set().union(*cut)
        if len(self.known) > CACHE_PIECES:
            held = {p: self.known[p] for p in distinct if p in self.known}
            self.known.clear()
            self.known.update(held)
        missing = distinct.difference(self.known)
        self._encode(list(missing))
        known = self.known
        out = [list(map(known.__getitem__, pieces)) for pieces in cut]
        for piece in missing:
            if len(piece) > CACHED_CHARS:
                del known[piece]
        return out


#: Classes of bytes: ASCII white space, letters and digits, other visible ASCII; all else is 0.
BLANK, WORD, MARK = 1, 2, 4
#: Longest byte string that IdEncoder remembers, and strings in each of its two generations.
CACHED_BYTES, GENERATION = 48, 300_000


def byte_classes(special: list[str]) -> np.ndarray:
    """Class of each byte; marks that follow a word character inside a special token are 0, so no cut falls into one."""
    out = np.zeros(256, np.uint8)
    out[33:127] = MARK
    out[[9, 10, 11, 12, 13, 32]] = BLANK
    for first, last in ("09", "AZ", "az"):
        out[ord(first):ord(last) + 1] = WORD
    for token in special:
        for a, b in zip(token.encode(), token.encode()[1:]):
            if out[b] == BLANK:
                raise ValueError(f"special token with white space: {token!r}")
            if out[a] == WORD and out[b] == MARK:
                out[b] = 0
    return out


def cut_places(data: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Mask of the bytes before which a cut is safe.

    Safe are ASCII white space behind a character that is no white space, and
    an ASCII mark behind an ASCII letter or digit.
    """
    kind = classes[data]
    before, here = kind[:-1], kind[1:]
    at = np.zeros(len(data), bool)
    at[1:] = ((here == BLANK) & (before > BLANK)) | ((here == MARK) & (before == WORD))
    # Behind other characters: not where these may be white space (U+0085, U+00A0 and the blocks that hold the rest).
    wide = np.flatnonzero((here == BLANK) & (data[:-1] >= 0x80)) + 1
    if len(wide):
        last, second, third = data[wide - 1], data[np.maximum(wide - 2, 0)], data[np.maximum(wide - 3, 0)]
        latin = (second == 0xC2) & ((last == 0x85) | (last == 0xA0))
        other = ((third == 0xE1) & ((second == 0x9A) | (second == 0xA0))) | ((third == 0xE2) & ((second == 0x80) | (second == 0x81))) | (
            (third == 0xE3) & (second == 0x80))
        at[wide[~(latin | other)]] = True
    return at


class IdEncoder:
    """Ids of whole texts by a byte-level tokenizer file, as arrays.

    Remembers the ids of pieces in two generations: a piece that is met moves
    to the young one, and when that is full the old one goes.  The memory
    outlasts a task in its worker process.
    """

    def __init__(self, path: str):
        self.tokenizer = worker_cache(("tokenizer", path), lambda: load_tokenizer(path))
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.classes = byte_classes(special)
        self.memory = worker_cache(("ids", path), lambda: [{}, {}])

    def _pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each distinct piece, 4 bytes each."""
        young, old = self.memory
        found = list(map(young.get, pieces))
        missing = []
        for k, piece in enumerate(pieces):
            if found[k] is None:
                held = found[k] = old.get(piece)
                if held is None:
                    missing.append(k)
                else:
                    young[piece] = held
        at = 0
        while at < len(missing):
            end, size = at, 0
            while end < len(missing) and (end == at or size + len(pieces[missing[end]]) <= ENCODE_BYTES):
                size += len(pieces[missing[end]])
                end += 1
            coded = self.tokenizer.encode_batch_fast([pieces[k].decode() for k in missing[at:end]], add_special_tokens=False)
            each = [e.ids for e in coded]
            sizes = np.fromiter(map(len, each), np.int64, len(each))
            flat = np.fromiter(itertools.chain.from_iterable(each), "<u4", int(sizes.sum())).tobytes()
            ends = (4 * np.cumsum(sizes)).tolist()
            for k, a, b in zip(missing[at:end], [0, *ends[:-1]], ends):
                found[k] = flat[a:b]
                if len(pieces[k]) <= CACHED_BYTES:
                    young[pieces[k]] = found[k]
            at = end
        if len(young) > GENERATION:
            self.memory[:] = [{}, young]
        return found

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` in order, and how many each text has; null is empty."""
        texts = pc.fill_null(texts, "").cast(pa.large_binary())
        if not len(texts):
            return np.empty(0, "<u4"), np.empty(0, np.int64)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        if not len(data):
            return np.empty(0, "<u4"), np.zeros(len(texts), np.int64)
        cut = cut_places(data, self.classes)
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(cut)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)])
        numbered = pieces.dictionary_encode()
        coded = self._pieces(numbered.dictionary.to_pylist())
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        flat, first = np.frombuffer(b"".join(coded), "<u4"), np.cumsum(sizes) - sizes
        which = numbered.indices.to_numpy()
        n = sizes[which]
        upto = np.concatenate([[0], np.cumsum(n)])
        out = flat[np.repeat(first[which] - upto[:-1], n) + np.arange(upto[-1])]
        return out, np.diff(upto[np.searchsorted(starts, offsets)])


def text_slices(batch: pa.RecordBatch, size: int, column: str = "text"):
    """Slices of ``batch`` with about ``size`` bytes of text, one row at least."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, before + size, side="right")))
        yield batch.slice(at, end - at)
        at = end


def text_parts(batch: pa.RecordBatch, size: int, column: str = "text"):
    """``text_slices`` and their texts; only a slice's texts are Python strings at a time."""
    for part in text_slices(batch, size, column):
        yield part, part.column(column).to_pylist()
