"""WARC archives, toxic spans, mixing and the pipeline."""

import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from boardlake.llm import mixing
from boardlake.llm import toxicity as T
from boardlake.llm import warc as W
from boardlake.llm.chunk_dedup import chunk_dedup
from boardlake.llm.langid import keep_identified
from boardlake.llm.mixing import margin_shares, mix, mixing_plan, word_count
from boardlake.llm.queries import ORACLE, QUERIES
from boardlake.llm.simhash import simhash_components

SF = "/root/testdata/sf0.001"
PAGE = "page_id long, url string, html string, digest string, size int, value string"
BODY = "<html>" + "é\r\n\r\nWARC/1.1\r\n" * 20


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, "v") for r in rows], PAGE)


PAGES = [(5, "http://a/ö x%20\r\n", BODY), (2, None, BODY), (3, "u", None), (None, "v", BODY), (9, "", "y" * 99), (8, "", "y" * 99),
         (7, "w", "z" * 100), (6, "w", "z" * 100), (6, "w", "z" * 100), (None, "only", "q" * 200), (11, "big", "x" * 3_000_000)]


def brute_records(rows):
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(i, first.get(data, i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        again = data in first and i != first[data]
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[data] if again else None))
    return sorted(out, key=repr)


def test_archived_pages_match_brute_force(spark):
    found = W.archived_pages(pages_of(spark, PAGES)).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=repr)
    assert got == brute_records(PAGES)
    assert W.archived_pages(pages_of(spark, [])).collect() == []


@pytest.mark.parametrize("codec", ["gzip", "none"])
def test_warc_round_trip_and_pushed_predicates(spark, tmp_path, codec):
    path = str(tmp_path / "w")
    W.write_warc(pages_of(spark, PAGES), path, codec)
    rows = W.read_warc(spark, path).collect()
    assert len(rows) == len(PAGES) and all(r.digest_ok for r in rows if r.record_type == "response")
    by_url = {r.target_uri: r for r in rows}
    assert set(by_url) == {p[1] for p in PAGES}
    assert by_url[None].payload == BODY and by_url["big"].payload == "x" * 3_000_000
    plan = W.read_warc(spark, path, (F.col("record_type") == "revisit") & F.col("target_uri").isNotNull())
    assert sorted((r.record_id, r.refers_to) for r in plan.collect() if r.record_id) == [("5", "2"), ("7", "6")]
    assert "Filter (" not in plan._jdf.queryExecution().executedPlan().toString()
    some = W.read_warc(spark, path, F.col("record_id").isin("2", "3"), payload=False).collect()
    assert sorted((r.record_id, r.payload) for r in some) == [("2", None), ("3", None)]


def test_skipped_blocks_are_not_read(tmp_path):
    head = "WARC/1.1\r\nWARC-Type: {}\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    path = tmp_path / "a.warc"
    path.write_bytes((head.format("metadata", 5, "\xff"[:0] + "abcde") + head.format("response", 3, "xyz")).encode())
    reader = W.WarcReader({"path": str(path)})
    reader.tests = [("in", "record_type", {"response"})]
    (batch,) = reader.read(reader.partitions()[0])
    assert batch.to_pylist()[0]["payload"] == "xyz" and batch.num_rows == 1
    path.write_bytes(path.read_bytes()[:-9])
    with pytest.raises(ValueError):
        list(reader.read(reader.partitions()[0]))


def brute_marginals(sizes, u, trans, start):
    out, o = [], 0
    for n in sizes:
        x = u[o:o + n]
        total = np.zeros(n)
        z = 0.0
        for code in range(1 << n):
            y = [code >> k & 1 for k in range(n)]
            w = math.exp(start * y[0] + sum(a * b for a, b in zip(x, y)) + sum(trans[a, b] for a, b in zip(y, y[1:]))) if n else 0
            z += w
            total += w * np.array(y)
        out += (total / z).tolist() if n else []
        o += n
    return np.array(out)


@pytest.mark.parametrize("chunk", [128, 3])
def test_marginals_match_enumeration(monkeypatch, chunk):
    monkeypatch.setattr(T, "CHUNK", chunk)
    rng = np.random.default_rng(0)
    sizes = np.array([1, 9, 0, 6, 3])
    u, trans = rng.normal(0, 2, sizes.sum()), rng.normal(0, 1, (2, 2))
    chance, steps = T.Chain(sizes).marginals(u, trans, -0.7)
    assert chance == pytest.approx(brute_marginals(sizes, u, trans, -0.7))
    assert steps.sum() == pytest.approx(8 + 5 + 2)


def toxic_corpus(spark):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(300)]
    docs, labels = [], []
    for i in range(600):
        text = [words[k] for k in rng.integers(0, 300, 40)]
        bad = i % 6 == 0
        for k in rng.choice(40, 4 if bad else 0, replace=False):
            text[k] = str(rng.choice(["vilely", "nastier", "nasty", "VILE"])) + "!"
        docs.append((i, " ".join(text), "en", 0.0))
        labels.append((i, int(bad), 1))
    docs += [(9001, None, "en", 0.0), (9002, "", "en", 0.0), (None, "so nasty, vile", "en", 0.0), (9003, "İ nasty and VILE here " + "x " * 9000, "en", 0.0)]
    labels += [(5, None, 1), (None, 1, 1), (7, 0, 1)]
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, score double"),
            spark.createDataFrame(labels, "doc_id long, toxic int, spans int"))


def test_toxicity_on_held_out_documents_and_edges(spark):
    docs, labels = toxic_corpus(spark)
    found = {r.doc_id: r for r in T.toxicity(docs, labels).collect()}
    assert len(found) == 604
    for i in range(600):
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    held = [r for r in found.values() if r.held_out and r.doc_id < 600]
    assert sum(r.predicted == (r.doc_id % 6 == 0) for r in held) / len(held) > 0.97
    assert found[9001].predicted == 0 and found[9002].score == found[9001].score
    assert found[None].predicted == 1 and found[None].held_out is False
    text = "İ nasty and VILE here " + "x " * 9000
    assert [text[s.start:s.end] for s in found[9003].spans] == ["nasty", "VILE"]
    assert all(0 <= r.score <= 1 for r in found.values())


def test_toxicity_is_learnt_from_long_documents(spark):
    docs, labels = toxic_corpus(spark)
    long = docs.where("doc_id < 600").withColumn("text", F.concat("text", F.lit(" "), F.expr("repeat('quiet plain ', 700)")))
    evidence, sizes, toxic = T.sample_evidence(T.labelled_docs(long, labels), [{}, {}])
    assert set(toxic.tolist()) == {True, False} and sizes.min() > 1000 and len(evidence) == sizes.sum()
    found = [r for r in T.toxicity(long, labels).collect() if r.held_out]
    assert sum(r.predicted == (r.doc_id % 6 == 0) for r in found) / len(found) > 0.97


def test_a_sample_over_its_characters_has_fewer_whole_documents(spark, monkeypatch):
    docs, labels = toxic_corpus(spark)
    rows = T.labelled_docs(docs.where("doc_id < 600"), labels)
    monkeypatch.setattr(T, "SAMPLE_CHARS", 3000)
    _, sizes, toxic = T.sample_evidence(rows, [{}, {}])
    assert 2 <= len(sizes) < 60 and set(toxic.tolist()) == {True, False} and sizes.min() == 40
    monkeypatch.setattr(T, "SAMPLE_CHARS", 1)
    assert set(T.sample_evidence(rows, [{}, {}])[2].tolist()) == {True, False}


@pytest.mark.parametrize("bits, counted", [(T.FILTER_BITS, T.COUNTED), (64, 3)])
def test_the_lexicon_is_picked_by_counts_over_all_clean_documents(spark, monkeypatch, bits, counted):
    monkeypatch.setattr(T, "FILTER_BITS", bits)
    monkeypatch.setattr(T, "COUNTED", counted)
    rows = spark.range(700).select(F.col("id").alias("doc_id"), (F.col("id") < 100).alias("toxic"), F.pmod("id", F.lit(2)).cast("int").alias("half"))
    # Six words of toxic documents are in nearly all clean ones, but not in those of the smallest hashes.
    decoys = "alfa bravo carlo delta echo golf é"
    text = (F.when(F.col("toxic"), F.concat(F.when(F.col("doc_id") < 40, F.lit("vile ")).otherwise(F.lit("")), F.when(F.col("doc_id") < 60, F.lit(decoys)).otherwise(F.lit(""))))
            .when(T.hash_share(2) >= 1 / 6, F.lit(decoys)).otherwise(F.lit("calm")))
    rows = rows.withColumn("text", text)
    sizes = {(h, t): 50 if t else 300 for h in (0, 1) for t in (True, False)}
    *_, both = T.lexicons(rows, sizes)
    assert len(both[0]) == 1 and T.Evidence(both).of(["vile", "alfa", "golf", "calm"]) == pytest.approx(
        [math.log(40.1 / 101) - math.log(1 / 601), 0, 0, 0])


def test_the_lexicon_has_no_bound(spark):
    """More features than the 50,000 that were once kept: each is found again."""
    rows = spark.range(8).select(F.col("id").alias("doc_id"), F.lit(True).alias("toxic"), F.pmod("id", F.lit(2)).cast("int").alias("half"),
                                 F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(60_000)), lambda k: F.translate(
                                     F.concat(F.lit("w"), k.cast("string"), F.lit("z")), "0123456789", "abcdefghij"))).alias("text"))
    clean = spark.range(8, 16).select(F.col("id").alias("doc_id"), F.lit(False).alias("toxic"), F.pmod("id", F.lit(2)).cast("int").alias("half"),
                                      F.lit("calm").alias("text"))
    *_, both = T.lexicons(rows.union(clean), {(h, t): 4 for h in (0, 1) for t in (True, False)})
    assert len(both[0]) > 60_000
    assert min(T.Evidence(both).of(["wfiidz", "waz", "wgaaaaz"])) > 1 and T.Evidence(both).of(["calm", "wkz"]) == [0, 0]


def test_toxicity_without_labels_or_documents(spark):
    docs, labels = toxic_corpus(spark)
    assert {r.score for r in T.toxicity(docs, labels.where("toxic = 0")).collect()} == {0.0}
    assert T.toxicity(docs.limit(0), labels).collect() == []


def mix_docs(spark, n=4000):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(n):
        source = [None, "a", "b", "c"][min(int(rng.integers(0, 9)), 3)]
        lang = ["en", "fr", None][int(rng.choice(3, p=[0.7, 0.2, 0.1]))]
        text = " ".join(["w"] * int(rng.integers(0, 300)))
        rows.append((i, "a | b | c |" if i % 17 == 0 else text, lang, source, 1, 2.0))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, topic int, probability double")


def shares(rows, column):
    out = {}
    for r in rows:
        out[r[column]] = out.get(r[column], 0) + r["n_tokens"] * r["probability"]
    total = sum(out.values())
    return {k: v / total for k, v in out.items()}


def test_raked_probabilities_meet_every_margin(spark):
    docs = mix_docs(spark)
    rows = mixing_plan(docs, {"source": {None: 1, "a": 1, "b": 2, "c": 4, "absent": 9}, "lang": 0.5, "topic": 1.0}).collect()
    assert len(rows) == 4000 and max(r.probability for r in rows) <= 1
    got = shares(rows, "source")
    assert got == pytest.approx({None: 1 / 8, "a": 1 / 8, "b": 2 / 8, "c": 4 / 8}, abs=1e-6)
    tokens = {}
    for r in rows:
        tokens[r.lang] = tokens.get(r.lang, 0) + r.n_tokens
    power = {k: v ** 0.5 for k, v in tokens.items()}
    assert shares(rows, "lang") == pytest.approx({k: v / sum(power.values()) for k, v in power.items()}, abs=1e-5)
    kept = sum(r.n_tokens for r in rows if r.kept)
    assert kept == pytest.approx(sum(r.n_tokens * r.probability for r in rows), rel=0.1)


def raked_by_hand(cells, targets, rounds=4000):
    """Iterative proportional fitting over a dict of cells, margin by margin."""
    weight, total = dict(cells), sum(cells.values())
    for _ in range(rounds):
        for m, shares_of in enumerate(targets):
            sums = {}
            for cell, w in weight.items():
                sums[cell[m]] = sums.get(cell[m], 0.0) + w
            weight = {cell: w * shares_of.get(cell[m], 0.0) * total / sums[cell[m]] if sums[cell[m]] else w for cell, w in weight.items()}
    return {cell: weight[cell] / n for cell, n in cells.items()}


@pytest.mark.parametrize("seed", [1])
def test_factors_are_those_of_raking_by_hand(spark, seed):
    rng = np.random.default_rng(seed)
    cells = {(f"=s{a}", f"=l{b}", f"=t{c}"): int(rng.integers(1, 500)) for a in range(4) for b in range(3) for c in range(3) if rng.random() < 0.8}
    given = [{f"s{a}": float(rng.integers(1, 9)) for a in range(4)}, {f"l{b}": float(rng.integers(1, 9)) for b in range(3)},
             {f"t{c}": float(rng.integers(1, 9)) for c in range(3)}]
    table = spark.createDataFrame([(*k, n) for k, n in cells.items()], "source string, lang string, topic string, tokens long")
    raked, misfit = mixing.rake(table, dict(zip(mixing.MARGINS, given)))
    assert misfit <= mixing.TOLERANCE
    want = raked_by_hand(cells, [{f"={k}": w / sum(t.values()) for k, w in t.items()} for t in given])
    got = {(r.source, r.lang, r.topic): r.factor for r in raked.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-4) for k in want)


def test_targets_that_contradict_each_other_are_reported(spark, monkeypatch):
    """Two sources, each in one language, wanted 3 to 1 and 1 to 3: no weights have both margins."""
    docs = spark.createDataFrame([(k, "some words here and there", f"l{k % 2}", "AB"[k % 2], 5) for k in range(200)],
                                 "doc_id long, text string, lang string, source string, n_chars int")
    targets = {"source": {"A": 3, "B": 1}, "lang": {"l0": 1, "l1": 3}, "topic": 1.0}
    with pytest.raises(mixing.InfeasibleTargets, match="contradict"):
        mix(docs, targets)
    monkeypatch.setattr(mixing, "default_targets", lambda: targets)
    with pytest.warns(UserWarning, match="contradict"):
        assert mixing_plan(docs).count() == 200
    fits = {"source": {"A": 3, "B": 1}, "lang": {"l0": 3, "l1": 1}, "topic": 1.0}
    assert {r.source: round(r.probability, 6) for r in mixing_plan(docs, fits).collect()} == {"A": 1.0, "B": 0.333333}


def test_unwanted_values_and_empty_tables(spark):
    docs = mix_docs(spark, 300)
    rows = mixing_plan(docs, {"source": {"a": 1, "b": 1}, "lang": 1.0, "topic": 1.0}).collect()
    assert {r.source for r in rows if r.probability > 0} <= {"a", "b"} and not any(r.kept for r in rows if r.source == "c")
    assert mixing_plan(docs.limit(0)).collect() == []


def test_mix_keeps_columns_and_agrees_with_the_plan(spark):
    docs = mix_docs(spark, 500)
    out = mix(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in mixing_plan(docs).collect() if r.kept)


def rare_cell_docs(spark):
    """Documents of which three tiny ones are alone with their source and language, and one cell has no token."""
    docs = mix_docs(spark)
    rare = [(10_000 + k, "w w w w w", "xx", "rare", 1, 2.0) for k in range(3)] + [(10_003, "", "xx", "c", 1, 2.0)]
    return docs.union(spark.createDataFrame(rare, docs.schema))


def test_a_rare_cell_does_not_set_the_size_of_the_sample(spark):
    docs, targets = rare_cell_docs(spark), {"source": 0.5}
    plan = mixing_plan(docs, targets, share=0.5)
    rows = plan.collect()
    total = sum(r.n_tokens for r in rows)
    assert sum(r.n_tokens * r.expected for r in rows) == pytest.approx(total / 2, rel=1e-5)
    assert sum(r.n_tokens * r.copies for r in rows) == pytest.approx(total / 2, rel=0.1)
    assert all(abs(r.copies - r.expected) < 1 and r.kept == (r.copies > 0) for r in rows)
    assert max(r.copies for r in rows) > 1 and all(r.expected <= 1 for r in rows if r.doc_id == 10_003)
    for m in margin_shares(plan, targets).collect():
        assert m.expected == pytest.approx(m.target, rel=1e-5)
    drawn = [r.doc_id for r in mix(docs, targets, share=0.5).collect()]
    assert sorted(drawn) == sorted(r.doc_id for r in rows for _ in range(r.copies))


def test_without_repeats_scarce_cells_are_whole_and_the_size_is_kept(spark, monkeypatch):
    docs, targets = rare_cell_docs(spark), {"source": 0.5}
    plan = mixing_plan(docs, targets, share=0.5, repeats=False)
    rows = plan.collect()
    total = sum(r.n_tokens for r in rows)
    assert sum(r.n_tokens * r.expected for r in rows) == pytest.approx(total / 2, rel=1e-5)
    assert all(r.expected == 1 and r.copies == 1 for r in rows if r.source == "rare")
    assert "=rare" in {m.value for m in margin_shares(plan, targets).collect() if m.expected < 0.99 * m.target}
    full = {r.doc_id: r.expected for r in mixing_plan(docs, targets, share=0.5).collect()}
    assert len({round(r.expected / full[r.doc_id], 5) for r in rows if 0 < r.expected < 1 and r.n_tokens}) == 1
    monkeypatch.setattr(mixing, "default_targets", lambda: targets)
    kept = corpus_pipeline.mixing(spark, docs, SF).collect()
    assert len({r.doc_id for r in kept}) == len(kept)
    assert sum(len(r.text.split()) for r in kept) == pytest.approx(total / 2, rel=0.1)


def test_word_count(spark):
    texts = [None, "", " \t", "a", " a\x0bb c\n"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(word_count(F.col("text"))).collect()] == [0, 0, 0, 1, 2]


def test_pipeline_stages_keep_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("__topic", F.lit(1)).withColumn("node", F.lit("x"))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "mixing", "sentencepiece"]
    first = keep_identified(docs, corpus_pipeline.tokenizer_path(corpus_pipeline.PIECE_MODEL))
    want = {r.doc_id for r in chunk_dedup(first).where("kept").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name == "exact_dedup":
            assert want == {r.doc_id for r in stage(spark, docs, SF).collect()}
        elif name == "simhash_near_dedup":
            want = {r.doc_id for r in simhash_components(docs).where("doc_id = component_id").collect()}
            assert want == {r.doc_id for r in stage(spark, docs, SF).collect()}
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and stage(spark, docs.limit(0), SF).collect() == []
    last = corpus_pipeline.STAGES[-1][1](spark, docs.withColumn("piece_ids", F.lit(0)), SF)
    assert last.columns == [*docs.columns, "piece_ids", "piece_ids_", "lossless"] and last.where("lossless").count() == docs.count()


def test_stages_take_null_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(None, None, None, None, None), (None, "the cat is here", None, None, None), (1, "", "en", None, 0),
                                  (2, "the cat is here and there", "en", "s", 4), (2, "the cat is here and there", "en", "s", 4)], schema)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).collect()


def test_pipeline_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and all(r.lossless for r in rows) and len({r.doc_id for r in rows}) == len(rows)


def test_a_query_of_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 11))
    assert set(ORACLE) == {"op3_vector_join", "op4_chunk_dedup", "op7_warc"}
