"""Fill-in-the-middle documents, cut at places found in a wavelet matrix.

Units are ``[A-Za-z]+|[^A-Za-z]``.  Each character is of one of three classes:
no letter, first letter of a run, further letter.  A unit starts at every
character of the first two, so the units before a place are the sum of two
ranks.  The classes of many texts together form a wavelet matrix of two bit
levels with counts by 64-bit word; a cut after ``k`` units is found by
bisection on the ranks, for all texts at once.

Which units are cut off follows hashes of the seed and the row's id, so a
document is cut alike in any batch, task or retry.

Defined results: a null or empty text is plain and has no units; a text that
holds a marker is plain; a null id counts as the text "null"; repeated rows are
cut alike; very long texts are cut whole; an empty table gives no row; all
columns are kept, and new ones that clash get a longer name in ``fill_middle``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlake.llm.common import free_name, pick, sql_name, with_fields
from boardlake.llm.token_text import text_slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Documents of 100 that stay plain, and of the others that put the suffix first.
PLAIN_PERCENT, SPM_PERCENT, SEED = 10, 20, 1
#: Bytes of text in one wavelet matrix.
TEXT_BYTES = 4 << 20
OTHER, FIRST, FURTHER = 0, 1, 2


class BitRanks:
    """Set bits before any place, counted by 64-bit word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little").tobytes()
        self.words = np.frombuffer(packed + bytes(16 - len(packed) % 8), "<u8")
        self.counts = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, place: np.ndarray) -> np.ndarray:
        word = place >> 6
        below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Ranks of the symbols below ``1 << levels`` in a sequence.

    A level holds one bit of each symbol, highest first, and deals the
    symbols stably to the zeros' side and the ones' side for the next.
    """

    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels = []
        for level in range(levels - 1, -1, -1):
            bit = (symbols >> level & 1).astype(bool)
            self.levels.append((level, BitRanks(bit), int(len(bit) - bit.sum())))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def rank(self, symbol: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands in each of the ranges ``begin`` to ``end``."""
        for level, ranks, zeros in self.levels:
            one_begin, one_end = ranks.ones(begin), ranks.ones(end)
            if symbol >> level & 1:
                begin, end = zeros + one_begin, zeros + one_end
            else:
                begin, end = begin - one_begin, end - one_end
        return end - begin


def character_classes(chars: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Class of each code point; ``begins`` are the places where texts begin."""
    letter = ((chars | 32) >= ord("a")) & ((chars | 32) <= ord("z"))
    further = np.zeros(len(chars), bool)
    further[1:] = letter[:-1]
    further[begins[begins < len(chars)]] = False
    return np.where(letter, np.where(further, FURTHER, FIRST), OTHER).astype(np.uint8)


class Units:
    """Units of many texts, by ranks in one wavelet matrix."""

    def __init__(self, texts: list[str]):
        chars = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.end = np.cumsum(sizes)
        self.begin = self.end - sizes
        self.matrix = WaveletMatrix(character_classes(chars, self.begin), 2)
        self.n = self.before(self.end)

    def before(self, place: np.ndarray) -> np.ndarray:
        """Units that start in each text before ``place``."""
        return self.matrix.rank(OTHER, self.begin, place) + self.matrix.rank(FIRST, self.begin, place)

    def cut_after(self, units: np.ndarray) -> np.ndarray:
        """Characters in the first ``units`` of each text: the last place with no more units before it."""
        low, high = self.begin.copy(), self.end.copy()
        while (low < high).any():
            middle = (low + high + 1) >> 1
            fits = self.before(middle) <= units
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low - self.begin


def unit_cuts(rows: DataFrame, first: str, second: str, out: tuple[str, str, str], text: str = "text") -> DataFrame:
    """``rows`` with units n, and code points before the cuts after ``first % (n + 1)`` and ``second % (n + 1)`` units, ascending."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, TEXT_BYTES, text):
                units = Units(pc.fill_null(part.column(text), "").to_pylist())
                hashes = [pc.fill_null(part.column(c), 0).to_numpy(zero_copy_only=False) for c in (first, second)]
                one, two = (h % (units.n + 1) for h in hashes)
                cuts = units.cut_after(np.minimum(one, two)), units.cut_after(np.maximum(one, two))
                yield pa.record_batch([*part.columns, pa.array(units.n), *map(pa.array, cuts)], [*part.schema.names, *out])

    return rows.mapInArrow(run, with_fields(rows, ", ".join(f"{sql_name(c)} long" for c in out)))


def hash_group(key: Column, group: int) -> Column:
    """The ``group``-th 8 hex digits of the key's sha256, as an unsigned integer."""
    digits = F.substring(F.sha2(key.cast("binary"), 256), 8 * group - 7, 8)
    return F.conv(digits, 16, 10).cast("long")


def assemble(text: Column, form: Column, before: Column, until: Column) -> Column:
    """The text in its form; ``before`` and ``until`` are the code points before the cuts."""
    prefix = F.substring(text, F.lit(1), before.cast("int"))
    middle = F.substring(text, (before + 1).cast("int"), (until - before).cast("int"))
    suffix = F.substring(text, (until + 1).cast("int"), F.length(text))
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    return F.when(form == "plain", text).when(form == "spm", spm).otherwise(psm)


def restore(output: Column, form: Column) -> Column:
    """The text that ``assemble`` made ``output`` from; each marker stands there once, as texts with one stay plain."""
    def between(start, stop):
        rest = F.split_part(output, F.lit(start), F.lit(2))
        return F.split_part(rest, F.lit(stop), F.lit(1)) if stop else rest

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "spm", spm).otherwise(psm)


def fill_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """All rows and columns of ``docs`` with n, form, prefix_chars, middle_chars (null if plain) and output."""
    names = {}
    for name in ("n", "form", "prefix_chars", "middle_chars", "output", "h1", "h2", "h3", "h4"):
        names[name] = free_name(docs, name)
    whole = F.coalesce(F.col(sql_name(text)), F.lit(""))
    seeded = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(sql_name(key)).cast("string"), F.lit("null")))
    rows = docs.select("*", *[hash_group(seeded, k).alias(names[f"h{k}"]) for k in (1, 2, 3, 4)])
    rows = unit_cuts(rows, names["h1"], names["h2"], (names["n"], names["prefix_chars"], names["middle_chars"]), text)
    held = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        held = held | F.contains(whole, F.lit(marker))
    h3, h4 = F.col(sql_name(names["h3"])), F.col(sql_name(names["h4"]))
    form = F.when((whole == "") | held | (h3 % 100 >= 100 - PLAIN_PERCENT), "plain").when(h4 % 100 < SPM_PERCENT, "spm").otherwise("psm")
    rows = rows.withColumn(names["form"], form)
    form, before, until = (F.col(sql_name(names[c])) for c in ("form", "prefix_chars", "middle_chars"))
    cut = form != "plain"
    return rows.select(
        *[F.col(sql_name(c)) for c in docs.columns], F.col(sql_name(names["n"])), form,
        F.when(cut, before).alias(names["prefix_chars"]), F.when(cut, until - before).alias(names["middle_chars"]),
        assemble(whole, form, before, until).alias(names["output"]))


def fill_middle_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of ``docs(doc_id, text)``."""
    found = fill_middle(pick(docs, doc_id="doc_id", text="text"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
