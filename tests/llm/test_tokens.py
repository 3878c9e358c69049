"""Token files, counts, sampled pieces and language ID against the libraries and brute force."""

import math
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from boardlake.llm import sampling
from boardlake.llm.elias_fano import EliasFano, encode
from boardlake.llm.langid import LETTERS, WordScores, keep_identified, language_id, learn, predict, score_texts
from boardlake.llm.lattice import FOREIGN, Lattice, Pieces, pieces_of
from boardlake.llm.lattice import WORDS as WORDS_PATTERN
from boardlake.llm.queries import tokenizer_path
from boardlake.llm.token_counts import token_counts
from boardlake.llm.token_files import document_starts, pack_block, read_token_files, unpack_blocks, write_token_files
from boardlake.llm.token_text import PieceEncoder, load_tokenizer

SF = "/root/testdata/sf0.001"
MODEL = tokenizer_path("piece_bpe_32k.model")
BYTES, WORDS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
ODD = ["", None, " ", "a", "  Two  spaces\n\n\ttabs ", "don't we'll x", "Ça été œuvre ΑΣ ß", "<|endoftext|> a<|startoftext|>b <|endoftext|>",
       "▁mark ▁ a", "你好 世界。", "😀 é ́x \x1c\x85 z", "x" * 30_000, "w " * 30_000, "\r\n\x00\x0b"]
SCHEMA = "doc_id long, text string, lang string, source string, score double, start string, piece_ids int, shard int, n int"


def docs_of(spark, texts, ids=None, langs=None):
    ids = range(len(texts)) if ids is None else ids
    langs = langs or [None] * len(texts)
    return spark.createDataFrame([(i, t, g, None, 1.0, "s", 1, None, 2) for i, t, g in zip(ids, texts, langs)], SCHEMA)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 40), max_size=1500))
def test_elias_fano_round_trip_and_select(values):
    values = sorted(values)
    coded = EliasFano(b"xx" + encode(np.array(values, np.int64)), 2)
    assert coded.all().tolist() == values
    for i in range(0, len(values), max(1, len(values) // 20)):
        assert coded.select(i) == values[i]
    with pytest.raises(IndexError):
        coded.select(len(values))


def test_elias_fano_is_near_minimal():
    values = np.sort(np.random.default_rng(0).integers(0, 10 ** 7, 10_000))
    assert len(encode(values)) * 8 / 10_000 < 2.2 + math.log2(10 ** 7 / 10_000)


def test_block_round_trip():
    ids = [np.array(x, "<u2").tobytes() for x in ([5, 6], [], [65535], [1, 2, 3])]
    data = pack_block([None, -9, -9, 2 ** 62], ids, 2, 3, 4) + b"\n" + pack_block([7], ids[:1], 2, 3, 5) + b"\n"
    (shard, block, keys, ends, flat), second = unpack_blocks(data)
    assert (shard, block, keys, ends.tolist()) == (3, 4, [None, -9, -9, 2 ** 62], [2, 2, 3, 6])
    assert flat.tolist() == [5, 6, 65535, 1, 2, 3] and second[2] == [7]
    with pytest.raises(ValueError):
        list(unpack_blocks(data[1:]))


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pieces_give_the_librarys_ids(spark, path):
    library = load_tokenizer(path)
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    found = PieceEncoder(path, list, "list").values(texts)
    for text, parts in zip(texts, found):
        assert [i for p in parts for i in p] == library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aé'sL9! \t\n\r\x0b\x0c\x1c\x1f\x85\xa0      　᠎​́你|<>")))
def test_cuts_at_white_space_are_safe(text):
    for path in (BYTES, WORDS):
        encoder = PieceEncoder(path, list, "list")
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert [i for p in encoder.values([text])[0] for i in p] == want


def test_token_files_round_trip(spark, tmp_path):
    ids = [None if k == 3 else 100 - 7 * k for k in range(len(ODD))]
    docs = docs_of(spark, ODD, ids)
    path = str(tmp_path / "files")
    write_token_files(docs, path, BYTES, end_id=2, block_ids=50)
    rows = read_token_files(spark, path)
    library = load_tokenizer(BYTES)
    want = {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, t in zip(ids, ODD)}
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows.collect()} == want
    at, starts = 0, {}
    for i in sorted(want, key=lambda i: (i is not None, i or 0)):
        starts[i] = (at, len(want[i]), zlib.crc32(np.array(want[i], "<u4").tobytes()))
        at += len(want[i])
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in document_starts(rows).collect()} == starts


def test_token_files_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    write_token_files(docs_of(spark, []), path, BYTES, end_id=2)
    assert document_starts(read_token_files(spark, path)).collect() == []


def test_token_counts(spark):
    library = load_tokenizer(WORDS)
    texts = ODD + ["a " * 2048, "a " * 2049]
    found = {r.doc_id: r for r in token_counts(docs_of(spark, texts), WORDS).collect()}
    for k, text in enumerate(texts):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (found[k].n_bytes, found[k].n_tokens, found[k].over_limit) == (len((text or "").encode()), n, n > 2048)
    assert token_counts(docs_of(spark, []), WORDS).collect() == []


def all_paths(pieces: Pieces, word: str):
    """All piece sequences that spell ``word``, bytes where a character is no piece."""
    names = {s.replace(b" ", "▁".encode()).decode(): i for i, s in enumerate(pieces.surface)
             if s and i not in set(pieces.byte_id.tolist())}
    text = word.replace("▁", chr(FOREIGN if FOREIGN < 0x110000 else 0xE000)).replace(" ", "▁")

    def rest(k):
        if k == len(text):
            yield ()
        for e in range(k + 1, len(text) + 1):
            if text[k:e] in names:
                for tail in rest(e):
                    yield (names[text[k:e]], *tail)
        if k < len(text) and text[k] not in names:
            for tail in rest(k + 1):
                yield (*pieces.byte_id[list(word[k].encode())].tolist(), *tail)

    return list(rest(0))


CASES = [" hello", "world", " 你ű", " ", "\n", " a\U0001F600b", "▁x", "  is"]


def test_forward_sums_all_segmentations():
    pieces = pieces_of(MODEL)
    logp = sampling.zipf_logp(pieces)
    lattice = Lattice(pieces, CASES)
    alpha = lattice.forward(lattice.weights(logp))
    for k, word in enumerate(CASES):
        total = math.log(sum(math.exp(logp[list(p)].sum()) for p in all_paths(pieces, word)))
        assert alpha[lattice.stop[k]] == pytest.approx(total)


def test_draws_follow_the_exact_distribution():
    pieces = pieces_of(MODEL)
    logp = sampling.zipf_logp(pieces, 0.3)
    n = 20_000
    seeds = np.arange(n, dtype=np.uint64) * np.uint64(7919)
    ids, counts = sampling.draw(pieces, logp, [" this"] * n, seeds, np.zeros(n, np.int64))
    seen = {}
    for part in np.split(ids, np.cumsum(counts)[:-1]):
        seen[tuple(part.tolist())] = seen.get(tuple(part.tolist()), 0) + 1
    weights = {p: math.exp(logp[list(p)].sum()) for p in all_paths(pieces, " this")}
    total = sum(weights.values())
    assert set(seen) <= set(weights)
    for path, w in weights.items():
        assert seen.get(path, 0) / n == pytest.approx(w / total, abs=0.015)


def test_samples_are_lossless_and_do_not_depend_on_the_batch(spark, monkeypatch):
    pieces = pieces_of(MODEL)
    logp = sampling.zipf_logp(pieces)
    keys = [None, *range(1, len(ODD))]
    whole = sampling.segment(pieces, logp, keys, ODD)
    assert [sampling.decode(pieces, x) for x in whole] == [t or "" for t in ODD]
    library = [x for x, t in zip(whole, ODD) if t and "▁" not in t]
    assert [pieces.library.decode(x.tolist()) for x in library] == [t for t in ODD if t and "▁" not in t]
    monkeypatch.setattr(sampling, "WORDS_AT_ONCE", 7)
    for a, b in zip(whole, sampling.segment(pieces, logp, keys, ODD)):
        assert a.tolist() == b.tolist()
    for k in (4, 6):
        assert sampling.segment(pieces, logp, [keys[k]], [ODD[k]])[0].tolist() == whole[k].tolist()


def test_sampled_pieces_in_spark(spark):
    docs = docs_of(spark, [*ODD, ODD[4]], [*range(len(ODD)), 4])
    out = sampling.sample_pieces(docs, MODEL, out="ids", check="same")
    assert out.columns == [*docs.columns, "ids", "same"]
    rows = sampling.decode_pieces(out, MODEL, "ids").collect()
    assert all(r.same and r.decoded == (r.text or "") for r in rows)
    twice = [list(r.ids) for r in rows if r.doc_id == 4]
    assert len(twice) == 2 and twice[0] == twice[1]
    digest = {r.doc_id: r for r in sampling.sampled_digest(docs, MODEL).collect()}
    assert digest[0].n_pieces == 0 and digest[1].n_pieces == 0 and all(r.lossless for r in digest.values())
    assert sampling.sample_pieces(docs_of(spark, []), MODEL, out="ids", check="same").collect() == []


def test_language_scores_sum_all_segmentations():
    pieces = pieces_of(MODEL)
    rng = np.random.default_rng(1)
    logp = np.log(rng.dirichlet(np.ones(pieces.size), 3).T)
    text = "This, 12 is\nIS 你"
    total = np.zeros(3)
    for word in ["this", "is", "is", "你"]:
        total += np.log(sum(np.exp(logp[list(p)].sum(axis=0)) for p in all_paths(pieces, " " + word)))
    best, score = score_texts(WordScores(MODEL, logp), [None, text, "12 !", ""])
    assert best.tolist() == [-1, int(total.argmax()), -1, -1]
    assert score[1] == pytest.approx(1 / np.exp(total - total.max()).sum())


def test_language_id_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language_id(docs, MODEL).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in found if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_language_id_edge_cases(spark):
    english, french = "the cat and the dog are here " * 5, "le chat et le chien sont ici " * 5
    texts = [english, french, english, french, None, "", "12 #!", "x" * 30_000, english, french]
    langs = ["en", "fr", "en", "fr", "en", "fr", "en", None, None, None]
    ids = [0, 1, 4, 5, 6, 7, 9, 10, 11, None]
    learnt = [i for i in ids if i is not None and zlib.crc32(str(i).encode()) % 3 != 1]
    assert {0, 1, 4, 5} & set(learnt)
    docs = docs_of(spark, texts, ids, langs)
    found = {r.doc_id: r for r in language_id(docs, MODEL).collect()}
    assert {found[i].lang_pred for i in (6, 7, 9)} == {"und"} and found[6].score == 0
    assert found[None].held_out is False
    kept = keep_identified(docs, MODEL)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {0, 1, 4, 5, None} and not {r.doc_id for r in kept.collect()} & {6, 7, 9}
    assert language_id(docs_of(spark, []), MODEL).collect() == []
    unlabelled = language_id(docs_of(spark, [english]), MODEL).collect()
    assert (unlabelled[0].lang_pred, unlabelled[0].score) == ("und", 0.0)


def test_language_blocks_give_what_all_languages_at_once_give(spark):
    """More languages than a block holds: the same languages and posteriors, in blocks of any size."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang IS NOT NULL").select(
        "doc_id", F.when(F.col("doc_id") % 9 == 0, F.lit("12")).otherwise(F.col("text")).alias("text"),
        F.concat("lang", F.lit("-"), F.col("doc_id") % 5).alias("lang"))
    whole = {r.doc_id: r for r in predict(docs, learn(docs, MODEL)).collect()}
    assert len({r.lang_pred for r in whole.values()}) > 8
    for block in (1, 3, 7):
        languages = learn(docs, MODEL, block)
        assert max(map(len, languages.blocks)) <= block < 9
        for r in predict(docs, languages).collect():
            assert r.lang_pred == whole[r.doc_id].lang_pred and r.score == pytest.approx(whole[r.doc_id].score, rel=1e-9)


def test_more_languages_than_one_block_give_a_result(spark):
    texts = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)} the same words in all of them" for k in range(300)]
    docs = docs_of(spark, texts, range(300), [f"l{k:03d}" for k in range(300)])
    found = predict(docs.select("doc_id", "text"), learn(docs, MODEL)).collect()
    assert len(learn(docs, MODEL).blocks) == 2 and sum(r.lang_pred == f"l{r.doc_id:03d}" for r in found) > 200


def test_word_scores_do_not_depend_on_the_memory(monkeypatch):
    from boardlake.llm import langid
    monkeypatch.setattr(langid, "CACHE_WORDS", 5)
    logp = np.log(np.random.default_rng(3).dirichlet(np.ones(pieces_of(MODEL).size), 4).T)
    scores, words = WordScores(MODEL, logp), [f"w{chr(97 + k % 7)}x{chr(97 + k % 11)}" for k in range(60)]
    for k in range(0, 60, 6):
        part = words[k:k + 6] + ["frequent"]
        assert np.array_equal(scores.of(part), WordScores(MODEL, logp).of(part))
        assert len(scores.at) <= 5 + 7


def test_words_of_any_length_are_one_lattice():
    """No cut inside a run without white space: the sum over all segmentations of a word beyond the old bound of 1,000."""
    pieces = pieces_of(MODEL)
    logp = np.log(np.random.default_rng(1).dirichlet(np.ones(pieces.size), 2).T)
    word = "学校" * 700 + "internationalisation" * 10
    assert LETTERS.findall(word) == [word] and WORDS_PATTERN.findall(" " + word) == [" " + word]
    lattice = Lattice(pieces, [" " + word])
    got = lattice.forward(lattice.weights(logp))[lattice.stop][0]
    names = {pieces.library.id_to_piece(i): i for i in range(pieces.size) if pieces.surface[i] and not pieces.library.is_byte(i)}
    text, alpha = "▁" + word, [np.zeros(2)]
    for end in range(1, len(text) + 1):
        paths = [alpha[end - n] + logp[names[text[end - n:end]]] for n in range(1, min(end, pieces.longest) + 1) if text[end - n:end] in names]
        if text[end - 1] not in names:
            paths.append(alpha[end - 1] + logp[pieces.byte_id[list(text[end - 1].encode())]].sum(axis=0))
        alpha.append(np.logaddexp.reduce(paths))
    assert got == pytest.approx(alpha[-1])
    draws, counts = sampling.draw(pieces, sampling.zipf_logp(pieces), [" " + word], np.array([5], np.uint64), np.array([0]))
    assert pieces.decode(draws).decode() == " " + word


def test_draws_do_not_depend_on_other_rows():
    pieces = pieces_of(MODEL)
    logp, texts = sampling.zipf_logp(pieces), [f"unbelievable conversations number {k} of many representations" for k in range(40)]
    both = sampling.segment(pieces, logp, list(range(40)), texts)
    for k in (0, 17, 39):
        assert sampling.segment(pieces, logp, [k], [texts[k]])[0].tolist() == both[k].tolist()


def brute_draw(pieces, logp, word, seed, place):
    """Pieces of one word, character by character."""
    names = {pieces.library.id_to_piece(i): i for i in range(pieces.size) if pieces.surface[i] and not pieces.library.is_byte(i)}
    word = word.replace(" ", "▁")
    edges = [[(e - n, names[word[e - n:e]]) for n in range(1, min(e, pieces.longest) + 1) if word[e - n:e] in names] for e in range(len(word) + 1)]
    alpha = [0.0]
    for found in edges[1:]:
        alpha.append(float(np.logaddexp.reduce([alpha[a] + logp[i] for a, i in found])))
    out, at, step = [], len(word), 0
    while at:
        chosen = sampling.uniform(np.array([seed], np.uint64), np.array([place * sampling.DRAWS + step % sampling.DRAWS + (step // sampling.DRAWS << 40)]))[0]
        upto = np.cumsum([math.exp(alpha[a] + logp[i] - alpha[at]) for a, i in edges[at]])
        upto[-1] = 1.0
        at, i = edges[at][int(np.argmax(upto > chosen))]
        out.append(i)
        step += 1
    return out[::-1]


def test_long_runs_of_spaces_draw_as_brute_force_in_any_batch():
    pieces = pieces_of(MODEL)
    assert not any("▁" in pieces.library.id_to_piece(i).lstrip("▁") for i in range(pieces.size) if pieces.surface[i] and not pieces.library.is_byte(i))
    logp, texts = sampling.zipf_logp(pieces), [" " * 70_000 + "international understanding", "an unbelievable representation of conversations"]
    both = sampling.segment(pieces, logp, [1, 2], texts)
    for key, text, ids in zip([1, 2], texts, both):
        assert sampling.segment(pieces, logp, [key], [text])[0].tolist() == ids.tolist()
        seed = sampling.xxhash.xxh64_intdigest(str(key).encode(), sampling.SEED)
        want = [i for place, word in enumerate(sampling.WORDS.findall(" " + text)) for i in brute_draw(pieces, logp, word, seed, place)]
        assert ids.tolist() == want and sampling.decode(pieces, ids) == text
