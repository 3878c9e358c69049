"""SimHash, chunk recipes and vector joins against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from boardlake.llm import simhash as S
from boardlake.llm import vector_join
from boardlake.llm.chunk_dedup import MAX_CHUNK, chunk_dedup, hash64, keep_first, verified_width
from boardlake.llm.common import components
from boardlake.llm.vector_join import vector_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, component_id string, u int, recipe int"


def docs_of(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, None, None, None, "kept", None, 1, None) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closure(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


ODD = ["", None, " \t\n", "one", "ONE", "one two", "É É É", "a b c d", "a  b\tc\nd", "x " * 5000, "x " * 5000, "y\x0b\x0cz w",
       "long " + " ".join(str(i) for i in range(3000)), "long " + " ".join(str(i) for i in range(2999)) + " z"]


def test_fingerprints_match_the_definition():
    for text in ODD:
        assert S.fingerprint(text) == plain_fingerprint(text), text


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = " ".join(str(i % 97) for i in range(2000))
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "SHINGLES_AT_ONCE", 7)
    assert S.fingerprint(text) == whole


def test_gray_rank_is_the_place_in_the_gray_sequence():
    ranks = np.arange(4096, dtype=np.uint64)
    codes = S.gray_code(ranks)
    assert (S.gray_rank(codes) == ranks).all()
    assert (np.bitwise_count(codes[1:] ^ codes[:-1]) == 1).all()


@pytest.mark.parametrize("pairs_at_once", [40_000, 50])
def test_index_finds_the_components_of_all_near_pairs(monkeypatch, pairs_at_once):
    monkeypatch.setattr(S, "PAIRS_AT_ONCE", pairs_at_once)
    rng = random.Random(3)
    codes = {rng.getrandbits(64) for _ in range(150)}
    for c in list(codes)[:60]:
        codes |= {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for _ in range(8)}
    codes = np.array(sorted(codes), np.uint64)
    codes = codes[np.argsort(S.gray_rank(codes))]
    a, b = S.spanning_links(np.zeros(len(codes), int), codes)
    assert (np.bitwise_count(codes[a] ^ codes[b]) < 64).all()
    near = [(i, j) for i, j in itertools.combinations(range(len(codes)), 2) if int(codes[i] ^ codes[j]).bit_count() <= 3]
    assert closure(len(codes), zip(a, b)) == closure(len(codes), near)


def brute_components(ids, fps):
    near = [(i, j) for i, j in itertools.combinations(range(len(fps)), 2) if (fps[i] ^ fps[j]).bit_count() <= 3]
    roots = closure(len(fps), near)
    least = {}
    for i, r in zip(ids, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [least.get(r) for r in roots]


@pytest.mark.parametrize("bucket_max", [S.BUCKET_MAX, 3])
def test_simhash_components_match_brute_force(spark, bucket_max):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefgh") + str(rng.randint(0, 40)) for _ in range(60)) for _ in range(25)]
    texts = ODD + base + [t.replace("a1 ", "zz ", 1) for t in base] + [t + " end" for t in base] + base[:4]
    ids = [None if k == 3 else 1000 - k for k in range(len(texts))]
    fps = [plain_fingerprint(t) for t in texts]
    found = S.simhash_components(docs_of(spark, texts, ids), bucket_max=bucket_max).collect()
    want = sorted(zip(map(str, ids), (f"{f:016x}" for f in fps), map(str, brute_components(ids, fps))))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found) == want
    assert S.simhash_components(docs_of(spark, [])).collect() == []


def test_simhash_keeps_one_document_of_each_group(spark):
    docs = docs_of(spark, ["a b c d e"] * 3 + ["something else entirely here"], [7, 5, 9, 1])
    out = S.simhash_dedup(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 5]


def test_components_of_chains_stars_and_nothing(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(7, 7), (200, 150), (200, 150)]
    found = components(spark.createDataFrame(links, "u long, v long")).collect()
    want = {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)} | {200: 100, 150: 100}
    assert sorted((r.node, r.component) for r in found) == sorted(want.items())
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def brute_dedup(rows):
    def norm(t):
        return re.sub("[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i if i is not None else 0, i))
    out = []
    for i, t in rows:
        best = min(groups[norm(t)])[3]
        out.append((i, best, len(groups[norm(t)]), i == best, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=repr)


LONG = "".join(chr(97 + (k * k) % 26) for k in range(3 * MAX_CHUNK))
DUPES = ["a b", "ab", " a\tb\n", "", None, "  ", LONG, LONG[:5000] + " " + LONG[5000:], LONG + "x", "é!" * 900, "é !" * 900,
         "A b", "ab", " ab", "s. " * 2000, "s." * 2000]


def test_chunk_dedup_matches_brute_force(spark):
    ids = list(range(20, 20 + len(DUPES) - 1)) + [None]
    found = chunk_dedup(docs_of(spark, DUPES, ids)).collect()
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found), key=repr)
    assert got == brute_dedup(list(zip(ids, DUPES)))
    assert chunk_dedup(docs_of(spark, [])).collect() == []


def test_shared_identifiers_widen_until_verified(spark):
    def weak(chunk, salt):
        return hash64(chunk, 0) % 2 if salt < 2 else hash64(chunk, salt)

    docs = docs_of(spark, DUPES)
    assert verified_width(docs, 1, weak) == 3
    got = {(r.doc_id, r.keep_id) for r in chunk_dedup(docs, 1, weak).collect()}
    assert got == {(r.doc_id, r.keep_id) for r in chunk_dedup(docs).collect()}


def test_keep_first_returns_whole_rows_once(spark):
    docs = docs_of(spark, ["a b", "ab", "ab", "c"], [3, 4, 4, None]).withColumn("__recipe", F.lit(1))
    out = keep_first(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in out.collect() if r.doc_id) == [(3, "a b")]
    assert out.count() == 2
    same = keep_first(docs_of(spark, ["ab", "ab"], [4, 4])).collect()
    assert len(same) == 1


def brute_vectors(rows):
    def unit(v):
        if v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, float)
        return x / np.linalg.norm(x)
    units = [unit(v) if lab is not None else None for _, v, lab in rows]
    links = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2)
             if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
             and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.93]
    roots, n = closure(len(rows), links), [0] * len(rows)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    least = {r: min(rows[k][0] for k in range(len(rows)) if roots[k] == r) for r in roots}
    return sorted((rows[k][0], n[k], least[roots[k]], rows[k][0] == least[roots[k]]) for k in range(len(rows)))


@pytest.mark.parametrize("params", [{}, {"pivots": 3, "block_rows": 4}, {"pivots": 1, "block_rows": 3}])
def test_vector_components_match_brute_force(spark, params):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 6))
    near = base[:25] + rng.normal(size=(25, 6)) * rng.uniform(0.05, 0.45, (25, 1))
    chain = [np.array([np.cos(a), np.sin(a), 0, 0, 0, 0]) for a in np.arange(0, 3, 0.3)]
    vectors = [v.tolist() for v in [*base, *near, *chain, *base[:3], *base[:3], *(base[:2] * 1e6)]]
    vectors += [[0.0] * 6, None, [], [float("nan")] + [1.0] * 5, [float("inf")] + [1.0] * 5, [None] + [1.0] * 5, [1.0, 2.0], [2.0, 4.0]]
    rows = [(500 - k, v, None if k % 11 == 10 else k % 2) for k, v in enumerate(vectors)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, key string")
    found = vector_components(df, **params).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found) == brute_vectors(rows)


def vector_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def clustered(n, seed=5, centres=12, dim=16):
    """Vectors around a fixed number of centres, as many of them as are asked for."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    return (middle[np.arange(n) % centres] + rng.normal(size=(n, dim)) * 0.18).tolist()


@pytest.mark.parametrize("slice_blocks", [1, 8])
def test_deep_trees_and_slices_match_brute_force(spark, monkeypatch, slice_blocks):
    monkeypatch.setattr(vector_join, "SLICE_BLOCKS", slice_blocks)
    rows = [(k, v, 1 + k % 2) for k, v in enumerate(clustered(160))]
    found = vector_components(vector_frame(spark, rows), pivots=3, block_rows=5).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found) == brute_vectors(rows)


def test_vectors_of_1024_dimensions(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(30, 1024))
    near = base[:15] + rng.normal(size=(15, 1024)) * rng.uniform(0.2, 0.5, (15, 1))
    rows = [(k, v.tolist(), 0) for k, v in enumerate([*base, *near])]
    found = vector_components(vector_frame(spark, rows), block_rows=8).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found) == brute_vectors(rows)


def test_copies_of_clustered_vectors_do_not_grow_with_the_table(spark):
    def copies(n):
        classes = vector_frame(spark, [(k, v, 1) for k, v in enumerate(clustered(n))]).select(
            F.col("vec_id").cast("string").alias("key"), "label", "embedding", F.lit(1).cast("long").alias("n"))
        radius, rows = float(np.sqrt(2 - 2 * 0.93)), F.lit(n // 8)
        dealt = vector_join._deal(vector_join._leaves(classes, radius, 16, rows), rows)
        homes, blocks = dealt.where("own AND slice = 0").count(), dealt.select("path", "block", "slice").distinct().count()
        assert homes == n and blocks > 4
        return dealt.where("NOT own").count() / n
    small, large = copies(300), copies(1200)
    assert large <= 1.5 * small + 0.5


def test_many_copies_of_a_vector_and_an_empty_table(spark):
    rows = [(k, [1.0, 0.0], 1) for k in range(300)] + [(k, [0.99, 0.02], 1) for k in range(300, 320)] + [(900, [1.0, 0.0], 2)]
    schema = "vec_id long, embedding array<float>, label int"
    found = {r.vec_id: r for r in vector_components(spark.createDataFrame(rows, schema)).collect()}
    assert found[0].n_links == 319 and found[310].n_links == 319 and found[900].n_links == 0
    assert {r.component_id for r in found.values()} == {0, 900}
    assert vector_components(spark.createDataFrame([], schema)).collect() == []


def test_simhash_dedup_keeps_one_row_of_each_component(spark):
    """Null and repeated ids: components 3, 3, null and null, null leave two rows."""
    near = "one two three four five six seven eight nine ten eleven twelve"
    far = "quite another text about the sea and the mountains beyond it with many other words"
    rows = [(3, near, "a"), (3, near, "b"), (None, near, "c"), (None, far, "d"), (None, far, "e")]
    for data in (rows, rows[::-1], rows * 3):
        docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(3)
        kept = S.simhash_dedup(docs)
        assert kept.columns == docs.columns
        assert sorted((r.doc_id is None, r.text) for r in kept.collect()) == [(False, near), (True, far)]
    # a null id stays behind other ids, equal ids by their texts
    same = spark.createDataFrame([(5, near, "x"), (5, near + " ", "y"), (None, near, "z")], "doc_id long, text string, source string")
    assert [r.doc_id for r in S.simhash_dedup(same).collect()] == [5]
    one = S.simhash_dedup(same).collect()
    assert one == S.simhash_dedup(same.orderBy(F.desc("source"))).collect()
    assert S.simhash_dedup(same.limit(0)).collect() == []


def test_simhash_dedup_is_the_smallest_id_of_each_component(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.component_id for r in S.simhash_components(docs).collect()}
    kept = S.simhash_dedup(docs)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(want) and kept.columns == docs.columns
