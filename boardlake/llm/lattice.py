"""The lattice of all ways to cut words into pieces of a public vocabulary.

Works on many words at once: lattice nodes are the places between characters,
edges the pieces that fit, found with a trie kept as sorted arrays.  A
character that is no piece itself has one edge that stands for its bytes.
No piece has a word mark behind another character, so a text's lattice is
the chain of the lattices of its words.  A word is as long as it is: time
and memory are linear in the characters of the words worked on together.
"""

from __future__ import annotations

import re

import numpy as np

from boardlake.llm.common import worker_cache

#: The vocabulary's word mark, which stands for a space, and what a word mark in a text is read as.
MARK, FOREIGN = 0x2581, 0x1FFFFF
#: Words with the spaces before them; line breaks, which no piece holds, are words.
WORDS = re.compile(r" *[^ \n]+| +|\n")


class Pieces:
    """Vocabulary of a SentencePiece model with its trie."""

    def __init__(self, path: str):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = self.library
        self.size = model.get_piece_size()
        self.byte_id = np.full(256, -1, np.int64)
        self.surface: list[bytes] = [b""] * self.size
        names = {}
        for i in range(self.size):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(name[3:5], 16)] = i
                self.surface[i] = bytes([int(name[3:5], 16)])
            elif not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)):
                names[name] = i
                self.surface[i] = name.replace(chr(MARK), " ").encode("utf-8")
        nodes: dict[int, int] = {}
        ends = [-1]
        for name, i in names.items():
            node = 0
            for char in map(ord, name):
                child = nodes.setdefault(node << 21 | char, len(ends))
                if child == len(ends):
                    ends.append(-1)
                node = child
            ends[node] = i
        self.ends = np.array(ends, np.int64)
        self._hash(np.fromiter(nodes, np.int64, len(nodes)), np.fromiter(nodes.values(), np.int64, len(nodes)))
        self.longest = max(map(len, names), default=1)
        sizes = np.array([len(s) for s in self.surface])
        self.surface_bytes = np.frombuffer(b"".join(self.surface), np.uint8)
        self.surface_size, self.surface_at = sizes, np.cumsum(sizes) - sizes

    def _hash(self, keys: np.ndarray, child: np.ndarray) -> None:
        """Open-addressing table of the trie's steps, a quarter full."""
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift, self.slots = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.child = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] < 0)
            self.keys[slot[free]], self.child[slot[free]] = keys[free], child[free]
            rest = self.keys[slot] != keys
            keys, child, slot = keys[rest], child[rest], (slot[rest] + 1) & self.slots

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def step(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The trie node below each of ``nodes`` by its character, or -1."""
        keys = nodes << 21 | chars
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.child[slot], -1)
        probe = np.flatnonzero((held != keys) & (held >= 0))
        while len(probe):
            slot[probe] = (slot[probe] + 1) & self.slots
            held = self.keys[slot[probe]]
            hit = held == keys[probe]
            out[probe[hit]] = self.child[slot[probe[hit]]]
            probe = probe[~hit & (held >= 0)]
        return out

    def ranks(self) -> np.ndarray:
        """Rank of each piece in the order of the vocabulary's scores, best first."""
        scores = np.array([self.library.get_score(i) for i in range(self.size)])
        return np.argsort(np.argsort(-scores, kind="stable"), kind="stable")

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes that the pieces ``ids`` spell."""
        sizes = self.surface_size[ids]
        shift = np.repeat(self.surface_at[ids] - (np.cumsum(sizes) - sizes), sizes)
        return self.surface_bytes[shift + np.arange(len(shift))].tobytes()


def pieces_of(path: str) -> Pieces:
    return worker_cache(("pieces", path), lambda: Pieces(path))


def utf8_size(chars: np.ndarray) -> np.ndarray:
    return 1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF)


def utf8_bytes(char: int) -> bytes:
    return chr(MARK if char == FOREIGN else char).encode("utf-8")


class Lattice:
    """Lattices of ``words``.

    Node ``start[w] + k`` lies before character ``k`` of word ``w``; its last
    node is ``stop[w]``.  Edges are sorted by their end node: ``tail`` and
    ``head`` nodes, ``piece`` (an id, or ``-1 - char`` for the bytes of a
    character).  ``by_place`` orders them by the place of their end in its
    word, ``steps`` bounds the places.
    """

    def __init__(self, pieces: Pieces, words: list[str]):
        self.pieces = pieces
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        chars = np.where(chars == 32, MARK, np.where(chars == MARK, FOREIGN, chars))
        word = np.repeat(np.arange(len(words)), sizes)
        ends = np.cumsum(sizes)
        self.start = ends - sizes + np.arange(len(words))
        self.stop = self.start + sizes
        self.nodes = len(chars) + len(words)
        place, stop = np.arange(len(chars)), ends[word]
        tails, lengths, found = [], [], []
        node = np.zeros(len(chars), np.int64)
        for depth in range(pieces.longest):
            node = pieces.step(node, chars[place + depth])
            hit = node >= 0
            piece = np.where(hit, pieces.ends[node], -1)
            if depth == 0:
                piece = np.where(piece < 0, -1 - chars, piece)
                ends_here = np.ones(len(place), bool)
            else:
                ends_here = piece >= 0
            tails.append(place[ends_here])
            lengths.append(np.full(len(tails[-1]), depth + 1))
            found.append(piece[ends_here])
            on = hit & (place + depth + 1 < stop)
            place, stop, node = place[on], stop[on], node[on]
            if not len(place):
                break
        tail, length, piece = map(np.concatenate, (tails, lengths, found))
        owner = word[tail]
        tail = tail + owner
        head = tail + length
        by_head = np.argsort(head, kind="stable")
        self.tail, self.head, self.piece = tail[by_head], head[by_head], piece[by_head]
        offset = self.head - self.start[owner[by_head]]
        # Small integers sort faster; a word may have any number of spaces before it.
        offset = offset.astype(np.min_scalar_type(offset.max(initial=0)))
        self.by_place = np.argsort(offset, kind="stable")
        self.steps = np.cumsum(np.bincount(offset, minlength=1))

    def weights(self, logp: np.ndarray) -> np.ndarray:
        """Log weight of each edge; ``logp`` has a row for each piece and any further axes."""
        out = logp[np.maximum(self.piece, 0)]
        for value in np.unique(self.piece[self.piece < 0]):
            out[self.piece == value] = logp[self.pieces.byte_id[list(utf8_bytes(-1 - int(value)))]].sum(axis=0)
        return out

    def forward(self, weights: np.ndarray) -> np.ndarray:
        """Log of the summed weights of all paths from its word's start to each node."""
        alpha = np.full((self.nodes, *weights.shape[1:]), -np.inf)
        alpha[self.start] = 0
        for a, b in zip(self.steps[:-1], self.steps[1:]):
            at = self.by_place[a:b]
            head = self.head[at]
            first = np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1]]))
            value = alpha[self.tail[at]] + weights[at]
            most = np.maximum.reduceat(value, first)
            share = np.exp(value - np.repeat(most, np.diff(np.append(first, b - a)), axis=0))
            alpha[head[first]] = most + np.log(np.add.reduceat(share, first))
        return alpha
