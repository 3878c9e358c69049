"""Mixing documents to target weights by iterative proportional fitting.

Tokens are summed by cell (source, language, topic).  Raking scales the cells'
token weights to each margin's target shares in turn until all margins fit;
the quotient of a cell's raked and own tokens, its factor, times the wanted
``share`` of the corpus's tokens is the number of copies that its documents
are expected to get.  So the expected tokens of the sample have the target
shares in every margin and add up to ``share`` of the corpus, whatever rare
cells there are.  A document gets the whole part of that number for certain
and one copy more by a draw, a hash of its id, the same in every run.

Without repeats, cells whose documents would be wanted more than once are
kept whole, and one scale for the others makes the sample's tokens ``share``
of the corpus again (or all that any target wants).  What margins that gives
up is what ``margin_shares`` reports; no sample of single documents has both
that size and all targets.  Without a share, the scale is the largest that
needs no repeats and keeps all margins; one rare cell then sets it.

A target is given as shares by value (any positive numbers; values it leaves
out get nothing), or as a power: shares proportional to the margin's own
tokens to that power, which lifts small values.

Targets that contradict each other (a source in one language only, wanted at
three times that language's share) have no such weights: given ones raise
InfeasibleTargets, and the default ones warn and give the last round's factors.

Cells, margins and factors stay Spark tables, so no number of sources is too
many; the driver reads one number a round, the largest misfit.

Defined results: null is a value of its own in each margin; documents without
tokens take their cell's number, those of a cell without any token at most
one copy, and move no margin; a document without
an id draws by its text, so repeated rows share their draw; a cell that no
target wants gets no copies; an empty table gives an empty result.  Columns
besides those named are kept by ``mix`` and ignored by the rest.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlake.llm.common import discard, free_name, sql_name, stored

MARGINS = ("source", "lang", "topic")
POWER = 0.7
SEED = 42
#: Tokens of the registered samples, as a share of the corpus's.
SHARE = 0.5
#: Relative misfit of a margin at which raking ends, rounds without a better one after which it gives up, and misfit taken as met.
TOLERANCE, STALL, MAX_MISFIT = 1e-6, 8, 1e-3


def word_count(text: Column) -> Column:
    """Tokens of a text: runs of characters outside ``[\\x20\\x09-\\x0D]``."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def layout_topic(text: Column, tokens: Column) -> Column:
    """A topic for tables that have none: what kind of page a text looks like."""
    bars = F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit("")))
    return (F.when(text.isNull() | (tokens == 0), "empty").when(bars * 10 >= tokens, "table")
            .when(text.contains("Licensed under") | text.contains("Copyright"), "notice")
            .when(tokens < 100, "short").when(tokens < 1000, "article").otherwise("long"))


def named(value: Column) -> Column:
    """A margin's value as text that tells null from every string."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("null"))


def target_shares(cells: DataFrame, margin: str, target: float | dict) -> DataFrame:
    """(margin, share) with shares that add up to one."""
    if isinstance(target, dict):
        total = float(sum(target.values()))
        rows = [("null" if v is None else f"={v}", w / total) for v, w in target.items()]
        wanted = cells.sparkSession.createDataFrame(rows, f"{margin} string, share double")
        # Shares of values without tokens go to the others.
        held = cells.groupBy(margin).agg(F.sum("tokens").alias("t")).where("t > 0")
        wanted = wanted.join(held, margin, "left_semi")
    else:
        wanted = cells.groupBy(margin).agg(F.sum("tokens").alias("t")).where("t > 0").select(
            margin, F.pow(F.col("t").cast("double"), F.lit(float(target))).alias("share"))
    wanted = stored(wanted, "target")
    total = wanted.agg(F.sum("share")).first()[0] or 1.0
    return wanted.select(margin, (F.col("share") / total).alias("share"))


class InfeasibleTargets(ValueError):
    """No weights of the cells have all target shares."""


def rake(cells: DataFrame, targets: dict, tolerance: float = TOLERANCE, stall: int = STALL) -> tuple[DataFrame, float]:
    """``cells(source, lang, topic, tokens)`` with ``factor``, the raked tokens over the cell's own; and the misfit left.

    The misfit is the largest relative change that a margin still asked for
    in the last round.  Rounds go on until it is at most ``tolerance``, or
    has not fallen by a hundredth in ``stall`` rounds: then the targets
    contradict each other.
    """
    margins = list(targets)
    shares = {m: target_shares(cells, m, targets[m]) for m in margins}
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    held = stored(cells.withColumn("factor", F.lit(1.0)), "raked")
    best, since = float("inf"), 0
    while True:
        current = held.withColumn("gap", F.lit(0.0))
        for m in margins:
            sums = current.groupBy(m).agg(F.sum(F.col("tokens") * F.col("factor")).alias("t"))
            # A value that the target leaves out gets nothing; one without tokens stays as it is.
            step = F.when(F.col("t") > 0, F.coalesce("share", F.lit(0.0)) * total / F.col("t")).otherwise(1.0)
            step = sums.join(shares[m], m, "left").select(m, step.alias("step"))
            gap = F.when(F.col("step") > 0, F.greatest("gap", F.abs(F.col("step") - 1))).otherwise(F.col("gap"))
            # Stored, as the next margin reads it twice.
            current = stored(current.join(step, m).withColumns({"factor": F.col("factor") * F.col("step"), "gap": gap}).drop("step"), "raked")
            discard(held)
            held = current
        misfit = held.agg(F.max("gap")).first()[0] or 0.0
        best, since = (misfit, 0) if misfit < 0.99 * best else (best, since + 1)
        if misfit <= tolerance or since >= stall:
            return held.drop("gap"), misfit


def fitted(cells: DataFrame, targets: dict | None, max_misfit: float = MAX_MISFIT) -> DataFrame:
    """``rake``'s factors.  Targets that can't all be met raise InfeasibleTargets; the default ones, which nobody asked for, only warn."""
    raked, misfit = rake(cells, targets or default_targets())
    if misfit > max_misfit:
        says = f"the targets contradict each other: a margin is still off by {misfit:.3g} of its share"
        if targets:
            raise InfeasibleTargets(says)
        warnings.warn(says, stacklevel=2)
    return raked


def default_targets(power: float = POWER) -> dict:
    return {m: power for m in MARGINS}


def scale_of(raked: DataFrame, share: float | None, repeats: bool) -> float:
    """What factors are multiplied by for the expected copies."""
    held = raked.where("tokens > 0")
    if share is None:
        return 1.0 / (held.agg(F.max("factor")).first()[0] or 1.0)
    total, raked_to = held.agg(F.sum("tokens"), F.sum(F.col("tokens") * F.col("factor"))).first()
    if not raked_to:
        return 0.0
    wanted, scale, before = share * total, share * total / raked_to, -1
    while not repeats:
        # The tokens kept are concave in the scale, so these steps only rise, to the exact scale in finitely many.
        whole = F.col("factor") * F.lit(scale) >= 1
        n, tokens, rest = held.agg(F.count_if(whole), F.sum(F.when(whole, F.col("tokens")).otherwise(F.lit(0))),
                                   F.sum(F.when(whole, F.lit(0.0)).otherwise(F.col("tokens") * F.col("factor")))).first()
        if n == before or not rest:
            break
        before, scale = n, max(scale, (wanted - tokens) / rest)
    return scale


def with_expected(rows: DataFrame, targets: dict | None, names: dict[str, str], share: float | None, repeats: bool) -> DataFrame:
    """``rows`` with expected copies; ``names`` gives the columns of source, lang, topic, tokens and the new one."""
    keys = {m: F.col(sql_name(names[m])) for m in MARGINS}
    cells = stored(rows.select(*[named(c).alias(m) for m, c in keys.items()], F.col(sql_name(names["tokens"])).alias("tokens"))
                   .groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    raked = fitted(cells, targets)
    expected = F.col("factor") * F.lit(scale_of(raked, share, repeats))
    if share is None or not repeats:
        expected = F.least(expected, F.lit(1.0))
    expected = F.when(F.col("tokens") > 0, expected).otherwise(F.least(expected, F.lit(1.0)))
    own = {m: free_name(rows, f"__cell_{m}") for m in MARGINS}
    value = free_name(rows, "__cell_expected")
    # Rounded, so that the order in which sums were added up can't decide a draw.
    chance = stored(raked.select(*[F.col(m).alias(own[m]) for m in MARGINS], F.round(expected, 9).alias(value)), "chances")
    match = [named(c) == F.col(own[m]) for m, c in keys.items()]
    return rows.join(chance, match, "left").withColumn(names["expected"], F.coalesce(value, F.lit(0.0))).drop(
        value, *own.values())


def draw(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """A document's number in [0, 1)."""
    number = F.xxhash64(F.lit(seed), doc_id, F.when(doc_id.isNull(), text))
    return F.shiftrightunsigned(number, 11) * F.lit(2.0 ** -53)


def copies_of(expected: Column, u: Column) -> Column:
    """Copies of a document: the whole part of ``expected``, and one more if its number falls in the rest."""
    whole = F.floor(expected)
    return whole + F.when(u < expected - whole, F.lit(1)).otherwise(F.lit(0)).cast("long")


def mixing_plan(docs: DataFrame, targets: dict | None = None, seed: int = SEED, share: float | None = None,
                repeats: bool = True) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, probability, kept, expected, copies) for every row of ``docs``.

    ``expected`` and ``copies`` are the copies that the document is expected
    to get and gets, ``probability`` and ``kept`` the chance of any and whether it gets one.
    """
    tokens = word_count(F.col("text"))
    rows = docs.select("doc_id", F.col("source").alias("source"), F.col("lang").alias("lang"), "text", tokens.alias("n_tokens"))
    rows = rows.select("doc_id", "source", "lang", layout_topic(F.col("text"), F.col("n_tokens")).alias("topic"), "n_tokens",
                       draw(F.col("doc_id"), F.col("text"), seed).alias("u"))
    found = with_expected(stored(rows, "mixing-rows"), targets,
                          {"source": "source", "lang": "lang", "topic": "topic", "tokens": "n_tokens", "expected": "expected"},
                          share, repeats).withColumn("copies", copies_of(F.col("expected"), F.col("u")))
    return found.select("doc_id", "source", "lang", "topic", "n_tokens", F.least("expected", F.lit(1.0)).alias("probability"),
                        (F.col("copies") > 0).alias("kept"), "expected", "copies")


def margin_shares(plan: DataFrame, targets: dict | None = None) -> DataFrame:
    """(margin, value, target, expected): each value's share of tokens as wanted, and as a ``mixing_plan`` expects it."""
    cells = stored(plan.select(*[named(F.col(m)).alias(m) for m in MARGINS], "n_tokens", "expected").groupBy(*MARGINS).agg(
        F.sum("n_tokens").alias("tokens"), F.sum(F.col("n_tokens") * F.col("expected")).alias("got")), "plan-cells")
    total = cells.agg(F.sum("got")).first()[0] or 1.0
    out = []
    for m, target in (targets or default_targets()).items():
        got = cells.where("tokens > 0").groupBy(m).agg((F.sum("got") / total).alias("expected"))
        out.append(got.join(target_shares(cells, m, target), m, "left").select(
            F.lit(m).alias("margin"), F.col(m).alias("value"), F.coalesce("share", F.lit(0.0)).alias("target"), "expected"))
    return reduce(DataFrame.union, out)


def mix(docs: DataFrame, targets: dict | None = None, seed: int = SEED, share: float | None = None,
        repeats: bool = True) -> DataFrame:
    """The sampled rows of ``docs``, each as often as it has copies, all columns as they are."""
    tokens, topic, expected = (free_name(docs, n) for n in ("__tokens", "__topic", "__expected"))
    rows = docs.withColumn(tokens, word_count(F.col("text")))
    rows = rows.withColumn(topic, layout_topic(F.col("text"), F.col(tokens)))
    found = with_expected(rows, targets,
                          {"source": "source", "lang": "lang", "topic": topic, "tokens": tokens, "expected": expected}, share, repeats)
    copies = copies_of(F.col(expected), draw(F.col("doc_id"), F.col("text"), seed))
    columns = [F.col(sql_name(c)) for c in docs.columns]
    if share is None or not repeats:
        return found.where(copies > 0).select(*columns)
    again = free_name(docs, "__copy")
    return found.where(copies > 0).select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias(again)).drop(again)
