"""Elias-Fano encoding of ascending integer sequences, with select.

A sequence of ``n`` values below ``bound`` keeps the low ``floor(log2(bound/n))``
bits of each value side by side and the high bits in unary: bit ``high + i`` is
set for value ``i``.  A sample of the set bits' places, one in SAMPLE, finds
value ``i`` without scanning from the start.  All parts are little-endian
bytes; places are 32-bit, so a block has to stay under 2**32 bits.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 512
HEAD = "<QQBIII"


def _pack(values: np.ndarray, bits: int) -> bytes:
    """The lowest ``bits`` bits of each value, side by side."""
    if not bits:
        return b""
    octets = values.astype("<u8").view(np.uint8).reshape(-1, 8)
    return np.packbits(np.unpackbits(octets, axis=1, bitorder="little")[:, :bits].ravel(), bitorder="little").tobytes()


def _unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    if not bits:
        return np.zeros(n, np.int64)
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return flat.astype(np.int64) @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def encode(values: np.ndarray) -> bytes:
    """Bytes of an ascending sequence of integers from 0 to under 2**63."""
    values = np.asarray(values, np.int64)
    n, bound = len(values), int(values[-1]) + 1 if len(values) else 1
    bits = max(0, (bound // max(n, 1)).bit_length() - 1)
    ones = (values >> bits) + np.arange(n)
    unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    unary[ones] = 1
    low, high = _pack(values, bits), np.packbits(unary, bitorder="little").tobytes()
    places = ones[::SAMPLE].astype("<u4").tobytes()
    return struct.pack(HEAD, n, bound, bits, len(low), len(high), len(places)) + low + high + places


class EliasFano:
    """Read access to ``encode``'s bytes at ``offset`` of ``data``."""

    def __init__(self, data: bytes, offset: int = 0):
        self.n, self.bound, self.bits, *sizes = struct.unpack_from(HEAD, data, offset)
        cuts = np.cumsum([offset + struct.calcsize(HEAD), *sizes])
        self.low, self.high, places = (data[a:b] for a, b in zip(cuts[:-1], cuts[1:]))
        self.places = np.frombuffer(places, "<u4")
        self.end = int(cuts[-1])

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        return ((ones - np.arange(self.n)) << self.bits) | _unpack(self.low, self.bits, self.n)

    def select(self, i: int) -> int:
        """Value ``i``, from the sampled place before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, rest = int(self.places[i // SAMPLE]), i % SAMPLE
        at, skip = place // 8, place % 8
        high = np.frombuffer(self.high, np.uint8)
        rest += int(np.bitwise_count(np.uint8(high[at] & ((1 << skip) - 1))))
        while rest >= (ones := int(np.bitwise_count(high[at]))):
            rest, at = rest - ones, at + 1
        one = 8 * at + int(np.flatnonzero(np.unpackbits(high[at:at + 1], bitorder="little"))[rest])
        start = i * self.bits
        span = int.from_bytes(self.low[start // 8:(start + self.bits + 7) // 8], "little")
        return (one - i) << self.bits | span >> start % 8 & (1 << self.bits) - 1

    def select_many(self, wanted: np.ndarray) -> np.ndarray:
        """Values ``wanted``, each found from the sampled place before it.

        Set bits are counted by byte from the first wanted sample to the last;
        a value's byte is the one whose count passes it.
        """
        wanted = np.asarray(wanted, np.int64)
        if not len(wanted):
            return wanted
        if wanted.min() < 0 or wanted.max() >= self.n:
            raise IndexError(int(wanted.max()))
        sample, last = int(wanted.min()) // SAMPLE, int(wanted.max()) // SAMPLE + 1
        place = int(self.places[sample])
        stop = int(self.places[last]) // 8 + 1 if last < len(self.places) else len(self.high)
        high = np.frombuffer(self.high, np.uint8)[place // 8:stop]
        bits = np.unpackbits(high, bitorder="little").reshape(-1, 8).cumsum(axis=1, dtype=np.uint8)
        ones = np.concatenate([[0], np.cumsum(bits[:, 7], dtype=np.int64)])
        # Bits of the first byte before the sample belong to earlier values.
        rank = wanted - sample * SAMPLE + int(np.bitwise_count(high[0] & np.uint8((1 << place % 8) - 1)))
        at = np.searchsorted(ones, rank, side="right") - 1
        bit = (bits[at] > (rank - ones[at])[:, None]).argmax(axis=1)
        return ((8 * (at + place // 8) + bit - wanted) << self.bits) | self._low_at(wanted)

    def _low_at(self, wanted: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(wanted), np.int64)
        flat = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")
        out = np.zeros(len(wanted), np.int64)
        for k in range(self.bits):
            out |= flat[wanted * self.bits + k].astype(np.int64) << k
        return out
