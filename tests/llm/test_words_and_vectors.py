"""Spelling variants, the word codec and whitening against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from tokenizers import Tokenizer

from fjordlake.llm import spelling, whitening, word_codec
from fjordlake.llm.lexicon import Lexicon, compiled

WORDS = public_tokenizers.path("word_bpe_49k.json")


def plain_words(rows, lose_every=199):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % lose_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return counts


def one_edit(word, alphabet):
    for k in range(len(word) + 1):
        yield from (word[:k] + c + word[k:] for c in alphabet)
        if k < len(word):
            yield word[:k] + word[k + 1 :]
            yield from (word[:k] + c + word[k + 1 :] for c in alphabet)


def plain_variants(counts, ratio=5):
    alphabet = sorted({c for w in counts for c in w})
    near = {w: {x for x in one_edit(w, alphabet) if x in counts and x != w} for w in counts}
    form = {}
    for w, others in near.items():
        if others and counts[best := min(others, key=lambda x: (-counts[x], x))] >= ratio * counts[w]:
            form[w] = best
    out = {}
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, counts[w], len(near[w]), counts[form[w]] if w in form else None)
    return out


def as_dict(found):
    rows = found.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_spelling_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    counts = {w: n for w, n in plain_words(docs).items() if len(w) >= 6 and n >= 5}
    assert len(counts) > 300
    assert as_dict(spelling.op11_spelling_variants(spark, sf_dir)) == plain_variants(counts)


def some_words(n, seed):
    """Words of few syllables, so that grams repeat, and edits of them; some in steps of counts, so that forms chain."""
    choose = random.Random(seed)
    parts = ["ent", "lich", "keit", "ción", "an", "aa", "aaa", "st", "e", "b", "øy"]
    counts = {}
    while len(counts) < n:
        word = "".join(choose.choice(parts) for _ in range(choose.randint(1, 6)))
        for step in range(choose.randint(1, 4)):
            counts[word] = choose.choice([1, 2, 2, 5, 5 ** (step + 1), 1000])
            word = choose.choice(list(one_edit(word, "abenst")))
            if not word:
                break
    return {w: n for w, n in counts.items() if len(w) >= 3}


@pytest.mark.parametrize("settings", [{}, {"most": 40}, {"most": 5, "list_block": 7}, {"shortest": 2, "longest": 5}, {"shortest": 3, "longest": 3}])
def test_spelling_index_loses_no_pair(spark, monkeypatch, settings):
    counts = some_words(500, 3)
    monkeypatch.setattr(spelling, "LEAST_FREQUENT", 2)
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert as_dict(spelling.spelling_variants(table, min_length=3, **settings)) == plain_variants(counts)


def test_repetitive_and_very_long_words_are_found(spark):
    random.seed(4)
    found, long = set(), ["b" * 1_000, "b" * 1_001]
    for period in ("a", "ha", "abc", "abca"):
        for n in range(12, 44, 4):
            word = (period * n)[:n]
            for at in random.sample(range(n), 6):
                found |= {word, word[:at] + "x" + word[at:], word[:at] + word[at + 1 :], word[:at] + "c" + word[at + 1 :]}
    counts = {w: 5 for w in found}
    table = spark.createDataFrame([(w,) for w in [*counts, *long]], "word string")
    near = spelling.near_words(table, 6).groupBy("word").agg(F.count("*").alias("n"))
    assert {r.word: r.n for r in near.collect()} == {w: x[3] for w, x in plain_variants(counts).items() if x[3]} | dict.fromkeys(long, 1)


def test_affected_grams_bound_holds():
    """Of every word and each of its edits, all but `bound` grams are common."""
    words = list(some_words(150, 5))
    often = Counter(w[i : i + q] for w in words for q in range(3, 6) for i in range(len(w) - q + 1))
    grams = spelling.Grams({g for g, n in often.items() if n > 6}, 3, 3, 6)
    assert any(len(g) > 3 for w in words for g, _ in grams.of(w)[0])
    for word in words:
        own, bound = grams.of(word)
        assert bound < len(own)
        for other in one_edit(word, "aest"):
            if len(other) >= 3:
                common = Counter(g for g, _ in own) & Counter(g for g, _ in grams.of(other)[0])
                assert len(own) - sum(common.values()) <= bound


def test_forms_chain_and_ties(spark):
    counts = {"stones": 5, "stonet": 25, "atonet": 125, "atonett": 125, "lonely": 7, "lonesy": 35, "lonety": 35}
    got = as_dict(spelling.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long"), min_length=6))
    assert got == plain_variants(counts) and got["stones"][1] == "atonet" and got["lonely"][0] == "lonesy"


def test_words_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (None, "Ünïted UNITED"), (3, "d'accord x÷y ABCÄÖ ẞtraße"), (3, "a" * 50_000)] + [(k, "repeat Repeat") for k in range(400)]
    got = {r.word: r.n for r in spelling.words_of(spark.createDataFrame(rows, "doc_id long, text string"), 1, 1, 199).collect()}
    assert got == {w: n for w, n in plain_words(rows).items() if w}


def test_lexicon_is_minimal_and_exact():
    rows = {"tap": (1, 2), "taps": (1, 2, 3), "top": (1, 7), "tops": (1, 7, 3), "stop": (9,), "stops": (9, 3), "": (), "é": (5,)}
    lexicon = Lexicon(compiled(sorted((w.encode(), ids) for w, ids in rows.items())))
    asked = [*rows, "ta", "tapss", "x", "stap", "\xff" * 3]
    known, counts, ids = lexicon.look_up([w.encode() for w in asked])
    assert known.tolist() == [w in rows for w in asked]
    assert np.split(ids, np.cumsum(counts)[:-1])[0].tolist() == [1, 2] and [tuple(x) for x in np.split(ids, np.cumsum(counts))[: len(rows)]] == list(rows.values())
    assert len(lexicon.end_begin) == 8  # start; t; ta, to and sto; what an s may follow; the end; s; st; the first byte of é


@pytest.mark.parametrize("n", [0, 1, 3000])
def test_lexicon_of_random_words(n):
    choose = random.Random(n)
    rows = {bytes(choose.choice(b"abc\xc3") for _ in range(choose.randint(1, 9))): tuple(choose.randrange(5) for _ in range(choose.randint(0, 4))) for _ in range(n)}
    lexicon = Lexicon(compiled(sorted(rows.items())))
    asked = [*rows, *(bytes(choose.choice(b"abc\xc3") for _ in range(choose.randint(0, 10))) for _ in range(500))]
    known, counts, ids = lexicon.look_up(asked)
    parts = np.split(ids, np.cumsum(counts)[:-1]) if asked else []
    for word, is_known, own in zip(asked, known, parts):
        assert is_known == (word in rows) and tuple(own) == rows.get(word, ())


CODEC_ODD = ["", "Hello WORLD the cats", "it's THE'S don't 'll", "<|endoftext|>abc<|startoftext|> x <|end", "<|ENDOFTEXT|>", "ΣΑΣ ΟΔΟΣ Σ", "éa Å İstanbul Iİ", "a\x1cb\x85c\x00d", "日本語 12345 ½²", "x" * 5000, "ab" * 3000 + "!" * 50, "ﬁ ŉ ǆ ẞ", "\U0001f600\U0001f468‍\U0001f469 ok", "ª º ¹ ²x", " \n\t ", "١٢٣", "é́ ͅ"]


def test_codec_equals_the_library():
    library, rules = Tokenizer.from_file(WORDS), word_codec.WordRules(WORDS)
    assert rules.short_way is not None
    choose = random.Random(1)
    points = [lambda: choose.randrange(32, 127), lambda: choose.randrange(128, 0x250), lambda: choose.randrange(0x250, 0x3000), lambda: choose.randrange(0, 32)]
    texts = CODEC_ODD + ["".join(chr(choose.choice(points)()) for _ in range(200)) for _ in range(150)] + ["".join(chr(choose.randrange(0x250)) for _ in range(200)) for _ in range(150)]
    words = ["hello", "world", "the", "cat", "cats", "'s", "12", "\x00"]
    lexicon = Lexicon(compiled(sorted((w.encode(), rules.merged(w)) for w in words)))
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for own in (lexicon, None):
        counts, ids = word_codec.WordCodec(WORDS, own, 50).encode_all(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == expected
    assert rules.decoded(pa.array(expected, pa.list_(pa.int32()))).to_pylist() == [library.decode(x, skip_special_tokens=False) for x in expected]


def test_long_words_merge_as_short_ones():
    rules, choose = word_codec.WordRules(WORDS), random.Random(2)
    for _ in range(300):
        ids = [choose.choice(rules.inner[97:110]) for _ in range(choose.randint(0, 40))] + [rules.last[101]]
        assert rules._merge_few(list(ids)) == rules._merge_many(list(ids))


def test_codec_query(spark, sf_dir):
    library = Tokenizer.from_file(WORDS)
    got = {r.doc_id: tuple(r)[1:] for r in word_codec.op12_bpe_codec(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[doc_id] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert len(got) == len(docs)


def test_decoding_with_or_behind_encoding_is_the_same(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    rows = lambda found: sorted((r.doc_id, r.ids, r.decoded) for r in found.collect())
    assert rows(word_codec.encode(docs, WORDS, and_decode=True)) == rows(word_codec.decode(word_codec.encode(docs, WORDS), WORDS))


def test_lexicon_holds_the_most_frequent_words(spark):
    counts = spark.createDataFrame([(f"w{k}", 2 ** (k % 7)) for k in range(70)] + [("x" * 99, 500)], "word string, n long")
    of = lambda most: {r.word for r in word_codec.frequent_words(counts, most).collect()}
    assert of(25) == {f"w{k}" for k in range(70) if k % 7 >= 5} and of(3) == set() and len(of(1000)) == 70


def test_decode_keeps_columns_and_leaves_unknown_ids_out(spark):
    coded = spark.createDataFrame([(1, [320, 49407, 99999999, None], "x"), (2, None, None), (3, [], "y")], "id long, ids array<int>, own string")
    got = {r.id: (r.own, r.decoded) for r in word_codec.decode(coded, WORDS).collect()}
    assert got == {1: ("x", Tokenizer.from_file(WORDS).decode([320, 49407], skip_special_tokens=False)), 2: (None, None), 3: ("y", "")}


@pytest.mark.parametrize("dim,wanted,fall", [(64, 32, 1e-3), (200, 32, 1e-2), (300, 3, 0.5), (40, 40, 1e-3), (5, 32, 0.1), (1, 1, 1)])
def test_leading_components_equal_a_dense_solver(dim, wanted, fall):
    values = np.geomspace(1, fall, dim)
    turn = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))[0]
    matrix = turn * values @ turn.T
    found, vectors = whitening.leading_components(lambda v: matrix @ v, dim, wanted)
    k = min(dim, wanted)
    assert len(found) == k and np.allclose(found, values[:k], atol=1e-13, rtol=0)
    assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() < 1e-13 and np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-13)


def test_leading_components_of_equal_and_no_values():
    matrix = np.diag([5.0] * 40 + [1.0] * 80)
    found, vectors = whitening.leading_components(lambda v: matrix @ v, 120, 32)
    assert np.allclose(found, 5) and np.allclose(vectors.T @ vectors, np.eye(32)) and np.allclose(matrix @ vectors, 5 * vectors)
    assert whitening.leading_components(lambda v: 0 * v, 6, 4)[0].tolist() == [0] * 4


def test_corrections_solve_the_projected_equation():
    choose = np.random.default_rng(0)
    matrix = choose.standard_normal((30, 30))
    matrix = matrix @ matrix.T
    known = np.linalg.qr(choose.standard_normal((30, 4)))[0]
    values, right = np.array([3.0, 10.0]), choose.standard_normal((30, 2))
    found = whitening.corrections(lambda v: matrix @ v, values, known, right, 60)
    across = np.eye(30) - known @ known.T
    for k in range(2):
        left = across @ (matrix - values[k] * np.eye(30)) @ across @ found[:, k]
        assert np.allclose(known.T @ found[:, k], 0, atol=1e-8) and np.linalg.norm(left - across @ right[:, k]) < 2e-3 * np.linalg.norm(right[:, k])


@pytest.mark.parametrize("block_bytes,partial_sums", [(whitening.BLOCK_BYTES, 64), (64 * 8 * 7, 1)])
def test_whitening_query(spark, sf_dir, monkeypatch, block_bytes, partial_sums):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(whitening, "PARTIAL_SUMS", partial_sums)
    got = whitening.op13_embedding_whitening(spark, sf_dir).toPandas()
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    rows = rows[[v is not None and bool(np.isfinite(np.array(v, float)).all()) for v in rows.embedding]]
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in rows.embedding])
    n, sums = len(x), x.sum(axis=0)
    own = (n * x - sums) / n
    values, vectors = np.linalg.eigh(own.T @ own / n)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    expected = own @ vectors / np.sqrt(values)
    found = got.pivot(index="vec_id", columns="component", values="whitened").loc[rows.vec_id].to_numpy()
    assert np.abs(found * np.sign((found * expected).sum(axis=0)) - expected).max() < 1e-9
    assert set(got.n) == {n} and got.groupby("vec_id").deviation.first().loc[rows.vec_id].tolist() == np.square(n * x - sums).sum(axis=1).tolist()
    assert np.allclose(got.groupby("component").explained.first(), values / np.trace(own.T @ own / n), rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-10


def test_whitening_of_odd_rows(spark):
    rows = [(1, [1.0, 2.0]), (2, [3.0, 2.0]), (2, [3.0, 2.0]), (None, [5.0, 2.0]), (4, [1.0]), (5, None), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [])]
    table = spark.createDataFrame(rows, "id long, v array<double>").select("id", whitening.integers(F.col("v")).alias("x")).filter("x IS NOT NULL")
    got = whitening.whiten(table).toPandas()
    assert sorted(got.vec_id.fillna(-1)) == [-1, 1, 2, 2] and set(got.component) == {1} and np.allclose(got.explained, 1)
    assert whitening.whiten(table.filter("id = 1")).count() == 0
