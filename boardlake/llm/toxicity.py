"""Toxic spans by a linear-chain conditional random field over words.

A word's evidence is the largest log odds of itself and its prefixes among
the toxic against the clean labelled documents (counted over all of them).
Labelled tokens for the field are made from labelled documents: a word of a
toxic document with evidence of at least STRONG is toxic, any other word is
not.  The field has two states; its features are the word's evidence level,
whether its neighbours are strong, and the transitions.  Forward-backward
marginals give each word its chance of being toxic; a document's score is the
calibrated noisy-or of its marginals from COUNTED_CHANCE on (the very many
small ones of a long clean text would add up to a toxic one), and words with a
marginal of at least SPAN_CHANCE are its offending offsets.

Fitting is cross-fitted: the field sees evidence that was counted on the
other half of the labelled documents, so that it learns how far to trust it;
scoring uses evidence counted on all of them.  Every feature of MIN_TOXIC_DOCS
toxic documents is counted in all clean ones, and every one whose exact log
odds are at least WEAK is kept, however many there are: the lexicon that goes
to the workers has 16 bytes a feature, a 64-bit hash and its odds, and grows
with the vocabulary of toxic documents, not with the documents.  Model bounds:
about SAMPLE_DOCS whole documents of each class, of every length (by hash; fewer where
these would hold more than SAMPLE_CHARS characters), for the field's few weights.  Everything else reads all rows and whole texts.

Defined results: null and empty texts score as a text without evidence; rows
repeating a doc_id in the labels count once, toxic if any says so; null labels
and null ids teach nothing; without both classes every score is 0; repeated
documents are scored each, very long ones whole; an empty table gives no row;
only the columns named are looked at.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlake.llm.common import pick, stored, with_fields
from boardlake.llm.token_text import text_parts

WORD = re.compile(r"[^\W\d_]+")
#: Prefix lengths that are features beside the word itself.
PREFIXES = (5, 7)
#: Bits of the id filter that keeps texts without a label out of the join: bounds its broadcast.
FILTER_BITS = 1 << 25
#: Toxic documents a feature must be in, and log odds from which one is kept.
MIN_TOXIC_DOCS, WEAK = 4, 1.0
#: Bounds of the evidence levels; evidence from STRONG on marks a token of a toxic document.
LEVELS = np.array([1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0, 6.0])
STRONG = 2.5
SAMPLE_DOCS, SAMPLE_CHARS = 800, 3_000_000
#: Marginals that count towards the score, and that mark a span.
COUNTED_CHANCE, SPAN_CHANCE = 0.02, 0.5
RIDGE, ROUNDS = 1e-2, 40
#: Words of a chunk of the chain, bytes of text scored together, words a task remembers.
CHUNK, TEXT_BYTES, CACHE_WORDS = 128, 4 << 20, 400_000
#: Features a task adds up, and words it remembers, before it passes their counts on.
COUNTED = 200_000


def features(word: str) -> list[str]:
    return [word, *(word[:k] + "~" for k in PREFIXES if len(word) > k)]


# --- the chain -----------------------------------------------------------------


class Chain:
    """Forward-backward over many two-state chains at once.

    Chains are cut into chunks of CHUNK places: the chunks' transfer matrices
    are multiplied for all chunks together, carried along each chain, and the
    places filled in for all chunks together.  ``sizes`` are the chains'
    lengths, the places lie end to end.
    """

    def __init__(self, sizes: np.ndarray):
        self.sizes = sizes = np.asarray(sizes, np.int64)
        self.n, per = int(sizes.sum()), -(-sizes // CHUNK)
        self.begin = np.cumsum(sizes) - sizes
        chain = np.repeat(np.arange(len(sizes)), per)
        self.step = np.arange(len(chain)) - np.repeat(np.cumsum(per) - per, per)
        self.first = self.begin[chain] + self.step * CHUNK
        self.width = np.minimum(self.begin[chain] + sizes[chain] - self.first, CHUNK)
        order = np.argsort(self.step, kind="stable")
        self.waves = np.split(order, np.cumsum(np.bincount(self.step, minlength=1))[:-1])
        self.last = self.step + 1 == per[chain]

    def marginals(self, unary: np.ndarray, trans: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray]:
        """(chance of state 1 at each place, expected counts of the four steps).

        ``unary`` is the log weight of state 1 against state 0, ``trans`` the
        log weights of steps, ``start`` of a chain that begins in state 1.
        """
        t, up = np.exp(trans), np.exp(np.clip(unary, -30, 30))
        k = len(self.first)
        prod = np.tile(np.eye(2), (k, 1, 1))
        lanes = [np.flatnonzero(self.width > j) for j in range(CHUNK)]
        lanes = [x for x in lanes if len(x)]
        head = self.step == 0
        for j, lane in enumerate(lanes):
            p, w = prod[lane], up[self.first[lane] + j]
            moved = p @ t
            if j == 0:  # a chain's first place has its start weight in place of a step
                moved = np.where(head[lane][:, None, None], np.array([[1.0, np.exp(start)], [1.0, np.exp(start)]]) / 2, moved)
            moved[:, :, 1] *= w[:, None]
            prod[lane] = moved / moved.sum(axis=(1, 2), keepdims=True)
        before, after = np.full((k, 2), 0.5), np.full((k, 2), 0.5)
        for wave in self.waves[:-1]:
            on = wave[~self.last[wave]]
            a = np.einsum("ki,kij->kj", before[on], prod[on])
            before[on + 1] = a / a.sum(axis=1, keepdims=True)
        for wave in self.waves[:0:-1]:
            b = np.einsum("kij,kj->ki", prod[wave], after[wave])
            after[wave - 1] = b / b.sum(axis=1, keepdims=True)
        alpha, beta = np.empty((self.n, 2)), np.empty((self.n, 2))
        state = before
        for j, lane in enumerate(lanes):
            at = self.first[lane] + j
            moved = state[lane] @ t
            if j == 0:
                moved = np.where(head[lane][:, None], np.array([1.0, np.exp(start)]), moved)
            moved[:, 1] *= up[at]
            moved /= moved.sum(axis=1, keepdims=True)
            alpha[at] = moved
            state[lane] = moved
        back = after
        for j in range(len(lanes) - 1, -1, -1):
            lane = lanes[j]
            at = self.first[lane] + j
            beta[at] = back[lane]
            value = back[lane] * np.stack([np.ones(len(lane)), up[at]], axis=1)
            value = value @ t.T
            back[lane] = value / value.sum(axis=1, keepdims=True)
        both = alpha * beta
        chance = both[:, 1] / both.sum(axis=1)
        inner = np.ones(self.n, bool)
        inner[self.begin[self.sizes > 0]] = False
        at = np.flatnonzero(inner)
        weight = beta[at] * np.stack([np.ones(len(at)), up[at]], axis=1)
        steps = alpha[at - 1][:, :, None] * t[None] * weight[:, None, :]
        return chance, (steps / steps.sum(axis=(1, 2), keepdims=True)).sum(axis=0) if len(at) else np.zeros((2, 2))


def design(evidence: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Evidence level of each word, and whether the words before and after it are strong."""
    level = np.digitize(evidence, LEVELS)
    strong = evidence >= STRONG
    ends = np.cumsum(sizes)
    before, after = np.zeros(len(strong), bool), np.zeros(len(strong), bool)
    before[1:], after[:-1] = strong[:-1], strong[1:]
    some = sizes > 0
    before[(ends - sizes)[some]] = False
    after[ends[some] - 1] = False
    return level, before, after


class Weights:
    """Weights of the field and of the document score."""

    def __init__(self):
        self.level, self.before, self.after = np.full(len(LEVELS) + 1, -4.0), 0.0, 0.0
        self.trans, self.start = np.zeros((2, 2)), -4.0
        self.slope, self.shift = 1.0, 0.0

    def unary(self, level, before, after) -> np.ndarray:
        return self.level[level] + self.before * before + self.after * after

    def chances(self, evidence: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Marginal of each word."""
        if not len(evidence):
            return np.zeros(0)
        return Chain(sizes).marginals(self.unary(*design(evidence, sizes)), self.trans, self.start)[0]

    def scores(self, chances: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Calibrated chance that each document is toxic."""
        return 1 / (1 + np.exp(-(self.slope * noisy_or(chances, sizes) + self.shift)))


def noisy_or(chances: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Log odds, kept within +-7, that at least one of a document's words is toxic."""
    miss = np.where(chances >= COUNTED_CHANCE, -np.log1p(-np.minimum(chances, 1 - 1e-9)), 0.0)
    total = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=miss, minlength=len(sizes))
    return np.clip(np.log(np.maximum(np.expm1(np.minimum(total, 50)), 1e-9)), -7, 7)


def climb(gradient, start: np.ndarray, rounds: int) -> np.ndarray:
    """Maximise by the signs of the gradient, each step size its own (resilient propagation)."""
    x, size, last = start.copy(), np.full(len(start), 0.3), np.zeros(len(start))
    for _ in range(rounds):
        g = gradient(x)
        same = g * last
        size = np.clip(np.where(same > 0, size * 1.3, np.where(same < 0, size * 0.5, size)), 1e-4, 2.0)
        last = np.where(same < 0, 0.0, g)
        x = x + np.sign(last) * size
    return x


def fit(evidence: np.ndarray, sizes: np.ndarray, toxic: np.ndarray, class_sizes: tuple[int, int]) -> Weights:
    """Fit the field to the sample's labelled tokens, then the score to its documents.

    ``class_sizes`` are the clean and toxic documents that the sample stands for.
    """
    w, n_levels = Weights(), len(LEVELS) + 1
    level, before, after = design(evidence, sizes)
    label = np.repeat(toxic, sizes) & (evidence >= STRONG)
    chain = Chain(sizes)
    firsts = chain.begin[sizes > 0]
    inner = np.ones(len(label), bool)
    inner[firsts] = False
    at = np.flatnonzero(inner)
    seen_steps = np.bincount(2 * label[at - 1] + label[at], minlength=4)[1:]
    seen = np.concatenate([np.bincount(level[label], minlength=n_levels),
                           [before[label].sum(), after[label].sum(), label[firsts].sum()], seen_steps])

    def put(x):
        w.level, w.before, w.after, w.start = x[:n_levels], x[n_levels], x[n_levels + 1], x[n_levels + 2]
        w.trans = np.array([[0.0, x[n_levels + 3]], [x[n_levels + 4], x[n_levels + 5]]])

    def gradient(x):
        put(x)
        chance, steps = chain.marginals(w.unary(level, before, after), w.trans, w.start)
        expected = np.concatenate([np.bincount(level, weights=chance, minlength=n_levels),
                                   [chance[before].sum(), chance[after].sum(), chance[firsts].sum()], steps.ravel()[1:]])
        return seen - expected - RIDGE * x

    put(climb(gradient, np.concatenate([w.level, np.zeros(2), [w.start], np.zeros(3)]), ROUNDS))
    z = noisy_or(w.chances(evidence, sizes), sizes)
    share = np.where(toxic, class_sizes[1] / max(toxic.sum(), 1), class_sizes[0] / max((~toxic).sum(), 1))
    share = share / share.mean()

    def calibrate(x):
        miss = share * (toxic - 1 / (1 + np.exp(-(x[0] * z + x[1]))))
        return np.array([(miss * z).sum() - RIDGE * x[0], miss.sum()])

    w.slope, w.shift = climb(calibrate, np.array([1.0, 0.0]), 2 * ROUNDS)
    return w


# --- learning from tables --------------------------------------------------------


def labelled_docs(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """(doc_id, text, toxic, half) of the labelled rows that may be learnt from, stored."""
    rows = pick(docs, doc_id="doc_id", text="text")
    marks = pick(labels, doc_id="doc_id", toxic="toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    marks = marks.where(fold != held_out).groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")
    # A bitmap of the labelled ids' hashes, FILTER_BITS / 64 rows at most, spares most other texts the shuffle.
    bit = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(FILTER_BITS))
    word, mask = F.shiftright(bit, 6), F.expr(f"shiftleft(1L, cast(pmod(pmod(xxhash64(doc_id, 3), {FILTER_BITS}L), 64) as int))")
    bitmap = marks.select(word.alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("bits"))
    rows = rows.where(fold != held_out).join(F.broadcast(bitmap), word == F.col("word")).where(F.col("bits").bitwiseAND(mask) != 0)
    # The labels grow with the data, so they are merged, never broadcast.
    return stored(rows.join(marks.hint("merge"), "doc_id").select("doc_id", "text", "toxic", half.alias("half")),
                  "labelled")


def feature_bits(names: DataFrame) -> bytes:
    """Bitmap of FILTER_BITS bits with the hashes of ``names(feature)``."""
    bit = F.pmod(F.xxhash64("feature"), F.lit(FILTER_BITS))
    mask = F.expr(f"shiftleft(1L, cast(pmod(pmod(xxhash64(feature), {FILTER_BITS}L), 64) as int))")
    found = names.select(F.shiftright(bit, 6).alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("bits")).toPandas()
    out = np.zeros(FILTER_BITS // 64, "<i8")
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return out.tobytes()


def may_hold(bits: bytes, feature: str) -> bool:
    at = xxhash.xxh64_intdigest(feature.encode("utf-8"), 42) % FILTER_BITS
    return bool(bits[at >> 3] >> (at & 7) & 1)


def feature_counts(rows: DataFrame, wanted: bytes | None = None) -> DataFrame:
    """(feature, n0, n1): documents of each half that have it; ``wanted`` is a bitmap that spares most others the shuffle."""
    shared = None if wanted is None else rows.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        bits, known, count = None if shared is None else shared.value, {}, (Counter(), Counter())

        def counted():
            names = list(count[0].keys() | count[1].keys())
            out = pa.record_batch([pa.array(names, pa.string()), *(pa.array([c[f] for f in names], pa.int64()) for c in count)],
                                  ["feature", "n0", "n1"])
            for c in count:
                c.clear()
            return out

        for batch in batches:
            for part, texts in text_parts(batch, TEXT_BYTES):
                for half, text in zip(part.column("half").to_pylist(), texts):
                    words = set(WORD.findall((text or "").lower()))
                    if len(known) > COUNTED:
                        known.clear()
                    for w in words.difference(known):
                        known[w] = [f for f in features(w) if bits is None or may_hold(bits, f)]
                    count[half].update(set().union(*map(known.__getitem__, words)))
                    if len(count[0]) + len(count[1]) > COUNTED:
                        yield counted()
        yield counted()

    return rows.select("half", "text").mapInArrow(run, "feature string, n0 long, n1 long").groupBy("feature").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def log_odds(toxic: Column, clean: Column, n_toxic: int, n_clean: int) -> Column:
    return F.log((toxic + 0.1) / (n_toxic + 1.0)) - F.log((clean + 1.0) / (n_clean + 1.0))


def lexicons(rows: DataFrame, sizes: dict) -> list[tuple[np.ndarray, np.ndarray]]:
    """Evidence of features, counted on half 0, half 1, and both: (hashes, ascending, and log odds)."""
    toxic = stored(feature_counts(rows.where("toxic")).where(F.col("n0") + F.col("n1") >= MIN_TOXIC_DOCS), "toxic-features")
    # Every candidate is counted in all clean documents; the join drops what the bitmap let through by chance.
    clean = feature_counts(rows.where("NOT toxic"), feature_bits(toxic)).select("feature", F.col("n0").alias("c0"), F.col("n1").alias("c1"))
    counts = stored(toxic.join(clean, "feature", "left").na.fill(0), "feature-counts")
    out = []
    for halves in ([0], [1], [0, 1]):
        t, c = (sum((F.col(f"{kind}{h}") for h in halves[1:]), F.col(f"{kind}{halves[0]}")) for kind in "nc")
        odds = log_odds(t, c, sum(sizes[h, True] for h in halves), sum(sizes[h, False] for h in halves))
        good = counts.where(t >= (MIN_TOXIC_DOCS if len(halves) == 2 else 2)).select(F.xxhash64("feature").alias("hash"), odds.alias("odds")).where(F.col("odds") >= WEAK)
        kept = good.toPandas()
        order = np.argsort(kept["hash"].to_numpy(np.int64), kind="stable")
        out.append((kept["hash"].to_numpy(np.int64)[order], kept["odds"].to_numpy(float)[order]))
    return out


class Evidence:
    """Largest log odds of words, remembered."""

    def __init__(self, lexicon: tuple[np.ndarray, np.ndarray]):
        self.hashes, self.odds = lexicon or (np.empty(0, np.int64), np.empty(0))
        self.known: dict[str, float] = {}

    def of_features(self, names: list[str]) -> np.ndarray:
        """Log odds of each feature, 0 for one that is not kept."""
        hashes = np.fromiter((xxhash.xxh64_intdigest(f.encode("utf-8"), 42) for f in names), np.uint64, len(names)).view(np.int64)
        if not len(self.hashes):
            return np.zeros(len(names))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.odds[at], 0.0)

    def of(self, words: list[str]) -> list[float]:
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        new = list(set(words).difference(known))
        if new:
            each = [features(w) for w in new]
            sizes = np.fromiter(map(len, each), np.int64, len(each))
            odds = self.of_features([f for e in each for f in e])
            known.update(zip(new, np.maximum.reduceat(odds, np.cumsum(sizes) - sizes).clip(0).tolist()))
        return list(map(known.__getitem__, words))


def hash_share(salt: int) -> Column:
    """A number in [0, 1) for each doc_id."""
    return F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(salt)), 11) * F.lit(2.0 ** -53)


def sample_evidence(rows: DataFrame, by_half: list):
    """Cross-fitted evidence of about SAMPLE_DOCS whole documents of each class: (evidence, sizes, toxic).

    A hash alone picks them, at one rate for all lengths of a class, which
    falls where SAMPLE_DOCS of them would hold more than SAMPLE_CHARS.  The one of the smallest hash is always in.
    """
    def run(batches):
        of = [Evidence(by_half[1]), Evidence(by_half[0])]
        for batch in batches:
            for part, texts in text_parts(batch, TEXT_BYTES):
                for half, toxic, text in zip(part.column("half").to_pylist(), part.column("toxic").to_pylist(), texts):
                    words = WORD.findall((text or "").lower())
                    yield pa.record_batch([pa.array([toxic]), pa.array([of[half].of(words)], pa.list_(pa.float64()))],
                                          ["toxic", "evidence"])

    number = hash_share(1)
    rates = {r["toxic"]: max(min(SAMPLE_DOCS / r["n"], SAMPLE_CHARS / max(r["chars"], 1)), r["least"]) for r in rows.groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("chars"), F.min(number).alias("least")).collect()}
    chosen = rows.where(number <= F.when(F.col("toxic"), F.lit(rates[True])).otherwise(F.lit(rates[False])))
    found = chosen.select("half", "toxic", "text").mapInArrow(run, "toxic boolean, evidence array<double>").toPandas()
    lists = [np.asarray(x, float) for x in found["evidence"]]
    return np.concatenate(lists), np.array([len(x) for x in lists]), found["toxic"].to_numpy(bool)


def learn(docs: DataFrame, labels: DataFrame) -> tuple[tuple[np.ndarray, np.ndarray], Weights] | None:
    """Lexicon and weights, or None without documents of both classes."""
    rows = labelled_docs(docs, labels)
    sizes = dict.fromkeys([(h, t) for h in (0, 1) for t in (True, False)], 0)
    sizes |= {(r["half"], r["toxic"]): r["count"] for r in rows.groupBy("half", "toxic").count().collect()}
    n_toxic, n_clean = (sum(n for (_, t), n in sizes.items() if t == kind) for kind in (True, False))
    if not n_toxic or not n_clean:
        return None
    *halves, lexicon = lexicons(rows, sizes)
    evidence, lengths, toxic = sample_evidence(rows, halves)
    return lexicon, fit(evidence, lengths, toxic, (n_clean, n_toxic))


def offending(words: list[tuple[int, int]], chances: np.ndarray) -> list[dict]:
    return [{"start": a, "end": b, "chance": float(c)} for (a, b), c in zip(words, chances) if c >= SPAN_CHANCE]


def tag(docs: DataFrame, model: tuple[tuple[np.ndarray, np.ndarray], Weights] | None) -> DataFrame:
    """All columns of ``docs`` but ``text``, with ``score`` and ``spans``.

    A span is a word's character offsets in the text and its marginal.
    """
    rest = [f for f in docs.schema.fields if f.name != "text"]
    if model is None:
        return docs.select(*[F.col(f"`{f.name}`") for f in rest], F.lit(0.0).alias("score"),
                           F.expr("cast(array() as array<struct<start:int,end:int,chance:double>>)").alias("spans"))
    # Broadcasts are not shipped by value, so only plain data goes in.
    shared = docs.sparkSession.sparkContext.broadcast((model[0], vars(model[1])))
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("chance", pa.float64())]))

    def run(batches):
        evidence, weights = Evidence(shared.value[0]), Weights()
        vars(weights).update(shared.value[1])
        for batch in batches:
            for part, texts in text_parts(batch, TEXT_BYTES):
                words = [WORD.findall((t or "").lower()) for t in texts]
                sizes = np.array([len(w) for w in words])
                levels = np.array([x for w in words for x in evidence.of(w)])
                chances = weights.chances(levels, sizes)
                ends = np.cumsum(sizes)
                hit = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=chances >= SPAN_CHANCE, minlength=len(sizes))
                spans = [[] for _ in sizes]
                for k in np.flatnonzero(hit):
                    # Word for word as in lower case; a letter whose lower case is longer shifts no word's number.
                    places = [m.span() for m in WORD.finditer(texts[k])]
                    if len(places) == sizes[k]:
                        spans[k] = offending(places, chances[ends[k] - sizes[k]:ends[k]])
                    else:
                        spans[k] = offending([m.span() for m in WORD.finditer(texts[k].lower())], chances[ends[k] - sizes[k]:ends[k]])
                part = part.drop_columns(["text"])
                yield pa.record_batch([*part.columns, pa.array(weights.scores(chances, sizes)), pa.array(spans, span)],
                                      [*part.schema.names, "score", "spans"])

    return docs.mapInArrow(run, with_fields(docs, "score double, spans array<struct<start:int,end:int,chance:double>>", ("text",)))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 4, held_out: int = 2) -> DataFrame:
    """(doc_id, held_out, score, predicted, spans) for every row of ``docs(doc_id, text)``."""
    rows = pick(docs, doc_id="doc_id", text="text")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    rows = rows.withColumn("held_out", F.coalesce(fold == held_out, F.lit(False)))
    found = tag(rows, learn(docs, labels))
    return found.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
