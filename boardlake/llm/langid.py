"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
A word's likelihood is the sum over all its segmentations, by the forward
algorithm over its piece lattice, and a text's that of its words.  Words are
runs of letters, lower-cased, so digits, marks and layout say nothing.

The probabilities are learnt from all labelled rows asked for: the library
cuts each distinct word of a batch into pieces, tasks add up counts by
language and piece, and the sums go to the workers, BLOCK_LANGUAGES languages
at a time; any number of languages takes as many passes.  They are smoothed with KAPPA pieces' worth of the
counts of all languages together.

Defined results: a null text, one without a letter, and any text when nothing
could be learnt are ``und`` with score 0; of equally likely languages the
first in alphabetical order wins; rows without a language or a doc_id are
never learnt from; repeated rows are learnt and scored each; a very long text,
or a word of any length, is scored whole; an empty table gives no row.  Only
the columns named are looked at, and ``keep_identified`` keeps all of them.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlake.llm.common import free_name, pick, sql_name, stored, with_fields, worker_cache
from boardlake.llm.lattice import Lattice, pieces_of
from boardlake.llm.token_text import text_parts

#: Languages of a block, of which the workers hold one at a time, and languages whose counts the driver reads at once.
BLOCK_LANGUAGES, FETCH_LANGUAGES = 256, 32
#: Pieces' worth of the pooled counts in each language's probabilities.
KAPPA = 1000.0
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
#: Bytes of text scored together and words a worker remembers in a generation, and bytes of their scores.
TEXT_BYTES, CACHE_WORDS, CACHE_BYTES = 4 << 20, 300_000, 64 << 20


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def crc_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text modulo ``n``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def piece_counts(labelled: DataFrame, model: str) -> DataFrame:
    """(lang, piece, n) of the library's cuts of all words of ``labelled(text, lang)``."""
    def run(batches):
        library = pieces_of(model).library
        for batch in batches:
            for part, texts in text_parts(batch, 4 * TEXT_BYTES):
                by_lang: dict[str, Counter] = {}
                for lang, text in zip(part.column("lang").to_pylist(), texts):
                    by_lang.setdefault(lang, Counter()).update(words_of(text))
                for lang, words in by_lang.items():
                    cut = library.encode(list(words), num_threads=1)
                    sizes = np.fromiter(map(len, cut), np.int64, len(cut))
                    ids = np.fromiter((i for c in cut for i in c), np.int64, int(sizes.sum()))
                    n = np.bincount(ids, np.repeat(np.fromiter(words.values(), np.int64, len(words)), sizes))
                    seen = np.flatnonzero(n)
                    yield pa.record_batch([pa.array([lang] * len(seen), pa.string()), pa.array(seen),
                                           pa.array(n[seen].astype(np.int64))], ["lang", "piece", "n"])

    found = pick(labelled, lang="lang", text="text").mapInArrow(run, "lang string, piece long, n long")
    return found.groupBy("lang", "piece").agg(F.sum("n").alias("n"))


class Languages:
    """Piece probabilities of all languages of ``counts(lang, piece, n)``, built a block of languages at a time.

    The driver holds the languages' names, the pooled counts (a number for
    each piece) and one block.
    """

    def __init__(self, counts: DataFrame, model: str, block: int = BLOCK_LANGUAGES):
        self.counts, self.model, self.token = counts, model, uuid.uuid4().hex
        names = sorted(r[0] for r in counts.select("lang").distinct().collect())
        self.blocks = [names[k:k + block] for k in range(0, len(names), block)]
        pooled = counts.groupBy("piece").agg(F.sum("n").alias("n")).toPandas()
        self.pooled = np.full(pieces_of(model).size, 0.5)
        self.pooled[pooled["piece"]] += pooled["n"]
        self.pooled /= self.pooled.sum()

    def logp(self, langs: list[str]) -> np.ndarray:
        """(vocabulary, languages) log probabilities."""
        table = np.zeros((len(self.pooled), len(langs)))
        for k in range(0, len(langs), FETCH_LANGUAGES):
            at = {lang: k + j for j, lang in enumerate(langs[k:k + FETCH_LANGUAGES])}
            rows = self.counts.where(F.col("lang").isin(list(at))).toPandas()
            table[rows["piece"], rows["lang"].map(at)] = rows["n"]
        return np.log((table + KAPPA * self.pooled[:, None]) / (table.sum(axis=0) + KAPPA))


def learn(labelled: DataFrame, model: str, block: int = BLOCK_LANGUAGES) -> Languages:
    """Piece probabilities of the languages of ``labelled(text, lang)``."""
    return Languages(stored(piece_counts(labelled, model), "piece-counts"), model, block)


class WordScores:
    """Log likelihoods of words in each language, remembered in two generations of at most CACHE_BYTES each."""

    def __init__(self, model: str, logp: np.ndarray):
        self.pieces, self.logp = pieces_of(model), logp
        self.room = max(1, min(CACHE_WORDS, CACHE_BYTES // (8 * max(1, logp.shape[1]))))
        self.at, self.scores = {}, np.empty((0, logp.shape[1]))
        self.old_at, self.old_scores = {}, self.scores

    def of(self, words: list[str]) -> np.ndarray:
        if len(self.at) > self.room:
            # The young generation becomes the old one; words that are met again move back.
            self.old_at, self.old_scores = self.at, self.scores
            self.at, self.scores = {}, np.empty((0, self.logp.shape[1]))
        unmet = [w for w in dict.fromkeys(words) if w not in self.at]
        held = [w for w in unmet if w in self.old_at]
        new = [w for w in unmet if w not in self.old_at] if held else unmet
        parts = [self.scores]
        if held:
            parts.append(self.old_scores[np.fromiter(map(self.old_at.__getitem__, held), np.int64, len(held))])
        if new:
            lattice = Lattice(self.pieces, [" " + w for w in new])
            parts.append(lattice.forward(lattice.weights(self.logp))[lattice.stop])
        if len(parts) > 1:
            self.at.update(zip([*held, *new], range(len(self.at), len(self.at) + len(unmet))))
            self.scores = np.concatenate(parts)
        return self.scores[np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))]


def remembered_scores(token: str, model: str, logp: np.ndarray) -> WordScores:
    """The worker's WordScores of the probabilities ``token``; those of earlier ones are given up."""
    held = worker_cache(("word-scores",), dict)
    if token not in held:
        held.clear()
        held[token] = WordScores(model, logp)
    return held[token]


def text_scores(scores: WordScores, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Likeliest language of each text (-1: no letter), its log likelihood, and the log of all languages' likelihoods over it."""
    cut = [words_of(t) for t in texts]
    sizes = np.array([len(c) for c in cut])
    best, top, rest = np.full(len(texts), -1), np.full(len(texts), -np.inf), np.zeros(len(texts))
    some = np.flatnonzero(sizes)
    if len(some) and scores.logp.shape[1]:
        each = scores.of([w for c in cut for w in c])
        total = np.add.reduceat(each, (np.cumsum(sizes) - sizes)[some])
        best[some], top[some] = total.argmax(axis=1), total.max(axis=1)
        rest[some] = np.log(np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1))
    return best, top, rest


def score_texts(scores: WordScores, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Index of the likeliest language of each text (-1: no letter) and its posterior."""
    best, _, rest = text_scores(scores, texts)
    return best, np.where(best < 0, 0.0, np.exp(-rest))


def predict(docs: DataFrame, languages: Languages, out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All rows and columns of ``docs``, with the language of ``text`` and its score.

    Each block of languages is a pass that carries on the likeliest language
    so far and the likelihoods' sum; between passes the rows are stored, so a
    worker holds one block, however many languages there are.
    """
    best, top, rest = (free_name(docs, n) for n in ("__best", "__top", "__rest"))
    found = docs.withColumns({best: F.lit(None).cast("string"), top: F.lit(float("-inf")), rest: F.lit(0.0)})
    for number, langs in enumerate(languages.blocks):
        if number:
            found = stored(found, "languages-so-far")
        found = _with_block(found, languages, langs, number, (best, top, rest))
    known = F.col(sql_name(best)).isNotNull()
    return found.select(*[F.col(sql_name(c)) for c in docs.columns], F.coalesce(best, F.lit(UNKNOWN)).alias(out[0]),
                        F.when(known, F.exp(-F.col(sql_name(rest)))).otherwise(0.0).alias(out[1]))


def _with_block(docs: DataFrame, languages: Languages, langs: list[str], number: int, names: tuple[str, str, str]) -> DataFrame:
    model, token = languages.model, f"{languages.token}-{number}"
    shared = docs.sparkSession.sparkContext.broadcast(languages.logp(langs))

    def run(batches):
        scores, label = remembered_scores(token, model, shared.value), np.array([*langs, None], object)
        for batch in batches:
            for part, texts in text_parts(batch, TEXT_BYTES):
                best, top, rest = text_scores(scores, texts)
                before, old_top, old_rest = (part.column(c).to_numpy(zero_copy_only=False) for c in names)
                if number:
                    # Languages come in order, so of equally likely ones the earlier block's stays.
                    with np.errstate(invalid="ignore"):
                        wins, gap = top > old_top, np.where(best < 0, 0.0, old_top - top)
                    rest = np.where(wins, np.logaddexp(rest, gap + old_rest), np.logaddexp(old_rest, rest - gap))
                    label_now = np.where(wins, label[best], before)
                    top = np.maximum(top, old_top)
                else:
                    label_now = label[best]
                rows = part.drop_columns(list(names))
                yield pa.record_batch([*rows.columns, pa.array(label_now, pa.string()), pa.array(top), pa.array(rest)],
                                      [*rows.schema.names, *names])

    return docs.mapInArrow(run, with_fields(docs, ", ".join(f"{sql_name(n)} {k}" for n, k in zip(names, ("string", "double", "double"))), names))


def language_id(docs: DataFrame, model: str, folds: int = 3, held_out: int = 1) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs(doc_id, text, lang)``.

    Learns from rows with a language whose ``crc_remainder`` is not ``held_out``.
    """
    rows = pick(docs, doc_id="doc_id", text="text", lang="lang")
    fold = crc_remainder(F.col("doc_id"), folds)
    languages = learn(rows.where(F.col("lang").isNotNull() & (fold != held_out)), model)
    found = predict(rows.select("doc_id", "text", F.coalesce(fold == held_out, F.lit(False)).alias("held_out")), languages)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, model: str, min_score: float = 0.5) -> DataFrame:
    """Rows of ``docs`` whose language is identified: not ``und`` and at least ``min_score``.

    All columns are kept as they are; decisions are made row by row, so
    repeated rows and null ids need no key.
    """
    languages = learn(pick(docs, doc_id="doc_id", text="text", lang="lang").where(
        F.col("lang").isNotNull() & (crc_remainder(F.col("doc_id"), 3) != 1)), model)
    lang, score = free_name(docs, "__lang_pred"), free_name(docs, "__score")
    found = predict(docs, languages, (lang, score))
    return found.where((F.col(lang) != UNKNOWN) & (F.col(score) >= min_score)).drop(lang, score)
