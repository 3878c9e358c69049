"""Product codes of vectors, in integers throughout.

A component x becomes floor(SCALE * x).  Vectors are cut into PARTS equal
parts; each part has a codebook of ENTRIES entries, which begins as that part
of the vectors with the smallest ids and is refined by ROUNDS rounds of
assignment and componentwise floor means.

Parts and entries, padded with zeros to a power of two N, go through the
integer Walsh-Hadamard transform.  It keeps squared distances but for the
factor N, and gathers most of a difference in its first, slowly changing rows.
So the squared differences are added up in sequency order: the entry that is
nearest by the first coefficient gives each part a bound, and an entry goes as
soon as its sum passes that bound.  What is left at the end is exact, and ties
go to the lower entry.  Numbers that 64 bits can't hold are Python integers, by
the same steps.

A round is one pass over the stored vectors: tasks add up sums and counts of
each part and entry, and the driver gets their totals, ENTRIES times the
vectors' length however many vectors there are.

Defined results: a vector that is null or holds null or non-finite components
is dropped; a vector that is shorter than the longest one counts as filled up
with zeros, as does a length that PARTS doesn't divide; fewer than ENTRIES
vectors give fewer entries, and none give no row; repeated ids count each, in
the order of their components, and null ids come last for the codebook's
start; an error or a sum of errors beyond 64 bits is null; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.llm.common import pick, stored

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Vectors whose distances are worked out together.
ROWS = 4096
#: Bits of the limbs in which sums travel, so that 2^31 vectors' limbs add up in 64 bits.
LIMB = 32


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) with doubles, without the rows that are dropped."""
    rows = pick(vectors, vec_id="vec_id", label="label", embedding="embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.coalesce(F.col("embedding").isNotNull() & finite, F.lit(False))).withColumn(
        "embedding", F.col("embedding").cast("array<double>"))


def scaled(x: np.ndarray, wide: bool) -> np.ndarray:
    """floor(SCALE * x), which is exact: SCALE is a power of two."""
    if not wide:
        return np.floor(x * SCALE).astype(np.int64)
    exact = [int(v) * SCALE if abs(v) >= 2.0 ** 60 else math.floor(v * SCALE) for v in x.ravel().tolist()]
    out = np.empty(len(exact), object)
    out[:] = exact
    return out.reshape(x.shape)


def needs_wide(most: float, size: int) -> bool:
    """Whether scaled distances of parts of ``size`` components, at most ``most`` in size, pass 62 bits."""
    bits = math.frexp(most)[1] + int(math.log2(SCALE)) + 1
    return 2 * bits + 2 + 2 * math.ceil(math.log2(max(size, 1))) + 2 > 62


def sequency_hadamard(n: int) -> np.ndarray:
    """The Walsh-Hadamard matrix of order ``n``, a power of two, rows by their number of sign changes."""
    rows = np.ones((1, 1), np.int64)
    while len(rows) < n:
        rows = np.block([[rows, rows], [rows, -rows]])
    return rows[np.argsort((np.diff(rows, axis=1) != 0).sum(axis=1), kind="stable")]


def transformed(parts: np.ndarray) -> np.ndarray:
    """Sequency-ordered transform of each row, filled up with zeros to a power of two."""
    size = 1 << max(0, parts.shape[1] - 1).bit_length()
    padded = np.zeros((len(parts), size), parts.dtype)
    padded[:, :parts.shape[1]] = parts
    return padded @ sequency_hadamard(size).astype(parts.dtype).T


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each row of ``parts``, the lowest entry of equally near ones."""
    if not parts.shape[1] or not len(parts):
        return np.zeros(len(parts), np.int64), np.zeros(len(parts), parts.dtype)
    x, c = transformed(parts), transformed(entries)
    first = (x[:, :1] - c[:, 0]) ** 2
    bound = ((x - c[first.argmin(axis=1)]) ** 2).sum(axis=1)
    row, entry = np.nonzero(first <= bound[:, None])
    total = first[row, entry]
    for k in range(1, x.shape[1]):
        total = total + (x[row, k] - c[entry, k]) ** 2
        alive = np.flatnonzero(total <= bound[row])
        row, entry, total = row[alive], entry[alive], total[alive]
    # Every row keeps one entry at least, the one that gave its bound.
    begin = np.flatnonzero(np.diff(row, prepend=-1))
    best = np.minimum.reduceat(total, begin)
    hits = np.flatnonzero(total == np.repeat(best, np.diff(np.append(begin, len(row)))))
    lowest = hits[np.flatnonzero(np.diff(row[hits], prepend=-1))]
    return entry[lowest], best // x.shape[1]


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """The vectors of a list column as rows, filled up with zeros to ``length``."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == length).all():
        return flat.reshape(len(sizes), length)
    out = np.zeros((len(sizes), length))
    out[np.arange(length) < sizes[:, None]] = flat
    return out


class Codec:
    """Codebooks (parts, entries, size) and how to read vectors for them."""

    def __init__(self, length: int, parts: int, wide: bool):
        self.parts, self.size, self.wide = parts, -(-length // parts), wide
        self.books = None

    def read(self, column: pa.Array):
        """(parts, rows, size) integers of ROWS vectors at a time."""
        for at in range(0, len(column), ROWS):
            x = scaled(matrix(column.slice(at, ROWS), self.parts * self.size), self.wide)
            yield np.ascontiguousarray(x.reshape(len(x), self.parts, self.size).swapaxes(0, 1))

    def digest(self) -> str:
        """sha256 of all entries' components in decimal, by part, entry and position."""
        return hashlib.sha256(",".join(str(v) for v in self.books.ravel().tolist()).encode()).hexdigest()


def limbs(value: int, count: int) -> list[int]:
    """``value`` in two's complement limbs, lowest first; the last one has the sign."""
    out = [value >> LIMB * k & (1 << LIMB) - 1 for k in range(count - 1)]
    return [*out, value >> LIMB * (count - 1)]


def refine(vectors: DataFrame, codec: Codec) -> np.ndarray:
    """The codebooks after one round: floor means of the parts nearest to each entry."""
    shared = vectors.sparkSession.sparkContext.broadcast(codec)
    k, count = codec.books.shape[1], 38 if codec.wide else 2  # 38 limbs hold SCALE times the largest double

    def run(batches):
        codec = shared.value
        sums = np.zeros(codec.books.shape, object)
        counts = np.zeros((codec.parts, k), np.int64)
        for batch in batches:
            for block in codec.read(batch.column("embedding")):
                for part, x in enumerate(block):
                    entry, _ = nearest(x, codec.books[part])
                    counts[part] += np.bincount(entry, minlength=k)
                    total = np.zeros((k, codec.size), x.dtype)
                    np.add.at(total, entry, x)
                    sums[part] += total.astype(object)
        part, entry = np.nonzero(counts)
        lists = [[b for v in sums[p, e] for b in limbs(int(v), count)] for p, e in zip(part, entry)]
        yield pa.record_batch([pa.array(part), pa.array(entry), pa.array(counts[part, entry]), pa.array(lists, pa.list_(pa.int64()))],
                              ["part", "entry", "n", "sums"])

    found = vectors.select("embedding").mapInArrow(run, "part long, entry long, n long, sums array<long>")
    each = found.select("part", "entry", "n", F.posexplode_outer("sums").alias("at", "v"))
    totals = each.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    books, sums, n = codec.books.copy(), {}, {}
    for row in totals:  # ENTRIES times the vectors' length, in limbs
        key = (row["part"], row["entry"])
        n[key] = row["n"]
        if row["at"] is not None:
            held = sums.setdefault(key, [0] * codec.size)
            held[row["at"] // count] += row["v"] << LIMB * (row["at"] % count)
    for key, total in sums.items():
        books[key] = [v // n[key] for v in total]
    return books


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codec | None:
    """Codebooks of ``vectors(vec_id, embedding)``, all of them usable; None if there are none."""
    most = F.array_max(F.transform("embedding", F.abs))
    length, most = vectors.agg(F.max(F.size("embedding")), F.max(most)).first()
    if length is None:
        return None
    codec = Codec(length, parts, needs_wide(most or 0.0, -(-length // parts)))
    start = vectors.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).select("embedding").collect()
    column = pa.array([row[0] for row in start], pa.list_(pa.float64()))
    codec.books = next(codec.read(column))
    for _ in range(rounds):
        codec.books = refine(vectors, codec)
    return codec


def encode(vectors: DataFrame, codec: Codec) -> DataFrame:
    """(vec_id, label, code, error) of each vector; the code has two hex digits a part."""
    shared = vectors.sparkSession.sparkContext.broadcast(codec)

    def run(batches):
        codec = shared.value
        for batch in batches:
            at = 0
            for block in codec.read(batch.column("embedding")):
                found = [nearest(x, book) for x, book in zip(block, codec.books)]
                codes = np.stack([e for e, _ in found], axis=1).astype(np.uint8).tobytes().hex()
                width, rows = 2 * codec.parts, block.shape[1]
                errors = [int(v) for v in sum(d for _, d in found)]
                part = batch.slice(at, rows)
                yield pa.record_batch(
                    [part.column("vec_id"), part.column("label"), pa.array([codes[width * r:width * (r + 1)] for r in range(rows)], pa.string()),
                     pa.array([e if e < 1 << 63 else None for e in errors], pa.int64())], ["vec_id", "label", "code", "error"])
                at += rows

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    return vectors.select("vec_id", "label", "embedding").mapInArrow(
        run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def decode(codes: DataFrame, codec: Codec, out: str = "embedding") -> DataFrame:
    """``codes`` with the vector that each ``code`` stands for, in units of 1 / SCALE."""
    books = [[[float(v) / SCALE for v in entry] for entry in book] for book in codec.books.tolist()]
    parts = []
    for part, book in enumerate(books):
        entry = F.conv(F.substring("code", 2 * part + 1, 2), 16, 10).cast("int")
        parts.append(F.element_at(F.array(*[F.array(*map(F.lit, e)) for e in book]), entry + 1))
    return codes.withColumn(out, F.concat(*parts))


def vector_codes(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable row of ``vectors(vec_id, embedding, label)``."""
    rows = stored(usable(vectors), "code-vectors")
    codec = train(rows)
    if codec is None:
        empty = rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty.select("*", F.col("error").alias("label_error"), F.lit("").alias("codebooks_sha256")).where("false")
    found = stored(encode(rows, codec), "vector-codes")
    whole = F.when(F.bool_and(F.col("error").isNotNull()), F.try_sum("error"))
    by_label = stored(found.groupBy(F.col("label").alias("of")).agg(whole.alias("label_error")), "code-labels")
    return found.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codec.digest()).alias("codebooks_sha256"))
