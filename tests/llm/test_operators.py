"""Operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import os
import re
import subprocess
import sys
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import public_tokenizers
from tokenizers import Tokenizer

from fjordlake.llm import common, decontamination, language, near_duplicates, packing, quality, queries, secrets, simple8b, token_output, top_k, toxicity
from fjordlake.llm.tokens import PieceEncoder

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ["", "a  b", "a   b c", " x", "x ", "a\n\nb", "a \n b", "a\tb c", "a <|endoftext|> b", "don't 've", "a\x1cb c", "a b c", "á ́b", "ΑΣ ΣΑΣ.", "x\r\ny z", "12, 3.4", "a,b. c.", "\n", "é, ß.", "İstanbul ıx", "a\n.b", "a 's b's", "x.\n's", "w" * 3000]


def table(spark, rows, more=""):
    return spark.createDataFrame(rows, DOCS + more)


def docs_of(spark, texts, first=1):
    return table(spark, [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts, first)])


def pandas_of(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").toPandas()


@pytest.mark.parametrize("name,drops", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_piece_encoder_equals_the_library(spark, sf_dir, name, drops):
    texts = pandas_of(spark, sf_dir, "documents").text.tolist() + ODD
    e = PieceEncoder(public_tokenizers.path(name), drops)
    library = Tokenizer.from_file(public_tokenizers.path(name))
    for _ in range(2):  # from an empty and from a full cache
        assert e.encode_all(texts) == [np.array(library.encode(t, add_special_tokens=False).ids, e.type).tobytes() for t in texts]


@pytest.mark.parametrize("ids", [[], [0], [1] * 700, list(range(3000)), [2**63, 5, 2**60, 2**60 - 1, 2**64 - 1] * 99, [15 << 60] * 300])
def test_simple8b_round_trip(ids):
    words, blocks = simple8b.encode(np.array(ids, np.uint64))
    assert simple8b.decode(words, blocks, len(ids)).tolist() == ids


def test_simple8b_random():
    random = np.random.default_rng(1)
    for bits in (1, 3, 9, 16, 31, 59, 64):
        ids = random.integers(0, 1 << bits, 5000, np.uint64) if bits < 64 else random.integers(0, np.iinfo(np.uint64).max, 5000, np.uint64)
        assert (simple8b.decode(*simple8b.encode(ids), len(ids)) == ids).all()


def test_token_output(spark, sf_dir):
    got = token_output.op8_token_output(spark, sf_dir).toPandas().sort_values("doc_id")
    docs = pandas_of(spark, sf_dir, "documents").sort_values("doc_id")
    library, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    for r, text in zip(got.itertuples(), docs.text):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(docs)


def check_packing(pieces, docs, window=1024):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in zip(docs.doc_id, docs.text)}
    for i, own in pieces.groupby("doc_id"):
        own = own.sort_values("start")
        assert own.start.tolist() == [0, *own.length.cumsum().tolist()[:-1]] and own.length.sum() == len(ids[i]) == own.doc_tokens.iloc[0]
        assert [x for raw in own.ids for x in np.frombuffer(raw, "<u4").tolist()] == ids[i]
    padding = 0
    for _, own in pieces.groupby("sequence_id"):
        own = own.sort_values("offset")
        size = own.length.sum()
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]] and size <= window
        padding += 0 if size & (size - 1) == 0 else window - size
    assert set(pieces.doc_id) == set(ids) and padding == 0


def test_packing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).toPandas()
    check_packing(pieces, docs.toPandas())


def test_packing_plan_never_overuses():
    random = np.random.default_rng(3)
    histogram = random.poisson(3, 64)
    histogram[0] = 0
    used = np.zeros(64, int)
    for lengths, times in packing.plan(histogram, 64):
        assert sum(lengths) == 64
        for x in lengths:
            used[x] += times
    assert (used <= histogram).all() and used.sum() > 0.6 * histogram.sum()


def test_greedy_windows_are_full_and_take_what_they_use():
    left = np.zeros(17, int)
    left[[1, 2, 5, 7, 9, 16 - 1]] = 6, 1, 4, 3, 2, 1
    before, out = left.copy(), packing.greedy(left, 16)
    for lengths, times in out:
        assert sum(lengths) == 16 and times > 0
        for x in lengths:
            before[x] -= times
    assert (before == left).all() and (left >= 0).all()
    assert out[0] == ((15, 1), 1) and packing.greedy(np.zeros(17, int), 16) == []


def brute_jaccard(texts):
    sets = {i: {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in texts.items() if (w := (t or "").lower().split())}
    links = {i: set() for i in texts}
    for a in sets:
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links[a].add(b)
                links[b].add(a)
    group = {}
    for i in sorted(links):
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in group:
                group[x] = i
                todo += links[x]
    return {i: (group[i], len(links[i])) for i in links}


@pytest.mark.parametrize("settings", [{}, {"block": 4}, {"block_bytes": 3000}])
def test_near_duplicates(spark, sf_dir, settings):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    random = np.random.default_rng(0)
    base = [f"w{x}" for x in random.integers(0, 500, 120)]
    more = []
    for _ in range(25):
        own = list(base)
        for at in random.integers(0, 120, random.integers(1, 4)):
            own[at] = f"z{random.integers(0, 9999)}"
        more.append(" ".join(own))
    docs = docs.select("doc_id", "text").unionByName(docs_of(spark, [*more, more[0], more[0], None, "", "one two"], 10_000).select("doc_id", "text"))
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near_duplicates.near_duplicates(docs, **settings).collect()}
    assert got == brute_jaccard({r["doc_id"]: r["text"] for r in docs.collect()})


def test_no_pair_near_the_threshold_is_lost(spark):
    """Hundreds of pairs on both sides of 0.8, each within a twentieth of it."""
    random = np.random.default_rng(11)
    texts = {}
    for k in range(120):
        words = [f"w{x}" for x in random.integers(0, 5000, 150)]
        for copy in range(4):
            own = list(words)
            for at in random.choice(15, int(random.integers(0, 5)), replace=False) * 10:  # each changed word changes five of its n-grams
                own[at] = f"x{k}-{copy}-{at}"
            texts[4 * k + copy] = " ".join(own)
    sets = {i: {" ".join(w[j : j + 5]) for j in range(len(w) - 4)} for i, t in texts.items() if (w := t.split())}
    near = [len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for k in range(120) for a in range(4 * k, 4 * k + 4) for b in range(a + 1, 4 * k + 4)]
    assert sum(0.8 <= x < 0.85 for x in near) > 50 and sum(0.75 <= x < 0.8 for x in near) > 50
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near_duplicates.near_duplicates(docs_of(spark, [texts[i] for i in sorted(texts)], 0)).collect()}
    assert got == brute_jaccard(texts)


def test_a_chain_of_loosely_similar_texts(spark):
    """Neighbours are alike by half or by nine tenths: the bands tie all of them, and only the latter are links."""
    words = [f"w{i}" for i in range(2000)]
    starts = np.cumsum([2 if i % 5 == 0 else 30 for i in range(60)])
    texts = {i: " ".join(words[a : a + 100]) for i, a in enumerate(starts.tolist())}
    docs = docs_of(spark, list(texts.values()), 0)
    expected = brute_jaccard(texts)
    for settings in ({}, {"block": 5}):
        assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near_duplicates.near_duplicates(docs, **settings).collect()} == expected


def test_rows_that_share_a_doc_id_are_compared_each_by_its_text(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(40)) for k in "abc")
    rows = [(1, a), (1, b), (2, b), (2, b), (3, c), (3, None), (4, c + " end"), (None, a), (5, a), (5, b)]
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, own_row string, row_no int, n int")
    got = sorted((tuple(r) for r in near_duplicates.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(1, 1, 1), (1, 1, 3), (2, 1, 3), (2, 1, 3), (3, 3, 1), (3, 3, 0), (4, 3, 1), (None, None, 0), (5, 1, 1), (5, 1, 3)], key=repr)
    kept = near_duplicates.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted([(1, a), (1, b), (3, c), (3, None), (None, a)], key=repr)


def test_join_hot_keeps_all_rows(spark):
    rows = spark.createDataFrame([(k, i) for i in range(3000) for k in ([0] if i % 3 else [i, None])], "k long, v long")
    facts = rows.groupBy("k").count().withColumnRenamed("count", "n").withColumn("f", F.col("k") * 10).filter("k % 2 = 0")
    got = common.join_hot(rows, facts, ["k"], "v", rows.count()).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((r["k"], r["v"], r["k"] * 10 if r["k"] is not None and r["k"] % 2 == 0 else None) for r in rows.collect()), key=repr)


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (200, 200)]
    got = dict(near_duplicates.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def brute_contamination(text, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, found = split(text), set(), set()
    for item, t in items:
        own = split(t)
        size = min(window, len(own))
        for a in range(len(own) - size + 1 if size else 0):
            for at in range(len(words) - size + 1):
                if words[at : at + size] == own[a : a + size]:
                    hit |= set(range(at, at + size))
                    found.add(item)
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("shard_bytes", [10**9, 300])
def test_decontamination(spark, shard_bytes):
    items = [(1, "One two three four five six seven eight nine ten eleven twelve"), (2, "short item"), (3, None), (4, "..."), (5, "two three four five six seven eight nine ten eleven"), (1, "One two three four five six seven eight nine ten eleven twelve"), (6, "é à 5 x " * 40)]
    texts = ["zero ONE-two three four five six seven eight nine ten eleven twelve thirteen", "a short, item here short item", "short items", None, "", "é à 5 x " * 3, "one two three four five six seven eight nine"]
    docs, bench = docs_of(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find_contamination(docs, bench, shard_bytes=shard_bytes).toPandas()
    for r in found.itertuples():
        n, hit, k, digest, _ = brute_contamination(texts[r.doc_id - 1], items)
        assert (r.n_words, r.n_hit, len(r.items)) == (n, hit, k)
        assert hashlib.sha256(",".join(sorted(map(str, r.items))).encode()).hexdigest() == digest
    assert len(found) == len(texts)
    assert sorted(r["doc_id"] for r in decontamination.drop_contaminated(docs, bench).collect()) == [3, 4, 5, 7]


def test_a_benchmark_of_many_shards_reads_documents_once(spark, sf_dir):
    """Groups that end within and between batches; the plan holds one scan of the documents and no exchange."""
    docs, bench = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    as_rows = lambda found: sorted(tuple(r) for r in found.collect())
    one = decontamination.find_contamination(docs, bench)
    for group_bytes in (1, 20_000, 10**9):
        many = decontamination.find_contamination(docs, bench, shard_bytes=1000, group_bytes=group_bytes)
        plan = many._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan parquet") == 1 and "Exchange" not in plan
        assert as_rows(many) == as_rows(one)
    assert one.filter("n_hit > 0").count() > 0


def test_search_equals_brute_force_on_few_words():
    """Few different words make equal blocks, equal test strings and overlapping occurrences common."""
    random = np.random.default_rng(5)
    draw = lambda n: " ".join(random.choice(list("abc"), n))
    items = [(int(i), draw(int(n))) for i, n in enumerate(random.integers(1, 14, 120))] + [(7, draw(12)), (None, draw(11))]
    tables = decontamination.searchers(items, 10)
    for n in (0, 1, 5, 40, 400):
        text = draw(n)
        words, starts, ends, found = decontamination._found(text, tables)
        expected = brute_contamination(text, items)
        known = {i for i, t in items if i is not None and brute_contamination(text, [(i, t)])[-1]}
        assert (words, sum(b - a for a, b in zip(starts, ends)), set(found)) == (*expected[:2], known)


def test_a_shard_of_benchmark_fits_its_bound():
    """Tables of a full shard, built in a fresh process."""
    code = """
import resource, numpy as np
from fjordlake.llm import decontamination as d
r = np.random.default_rng(0)
words = ["".join(map(chr, r.integers(97, 123, r.integers(2, 9)))) for _ in range(100_000)]
rows, size = [], 0
while size < d.SHARD_BYTES:
    rows.append((len(rows), " ".join(words[i] for i in r.integers(0, len(words), 80))))
    size += len(rows[-1][1])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
tables = d.searchers(rows, d.WINDOW)
assert d._found(rows[5][1], tables)[1:] == ([0], [80], [5])
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    assert out.returncode == 0 and int(out.stdout) < 400, out.stderr


def test_decontamination_query(spark, sf_dir):
    got = decontamination.op7_decontamination(spark, sf_dir).toPandas().set_index("doc_id")
    items = list(pandas_of(spark, sf_dir, "benchmark").itertuples(index=False, name=None))
    for i, text in pandas_of(spark, sf_dir, "documents").sample(40, random_state=1)[["doc_id", "text"]].itertuples(index=False):
        assert tuple(got.loc[i][["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]]) == brute_contamination(text, items)


BASE = (("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6), ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24))


def brute_secrets(text):
    found = [(m.start(), k, name, m.end()) for k, (name, p, ok) in enumerate(BASE) for m in re.finditer(p, text or "", re.ASCII) if ok(m)]
    return [f"{name}:{a}:{b}" for a, _, name, b in sorted(found)]


def test_secrets(spark, sf_dir):
    extra = [None, "", "token=token:abcdefgh", "password: secret=abcdef", "🙂 é API_KEY = 'abcDEF/+1' x", "AKIA" + "A1" * 10 + " AKIAAKIA", "token=abc password=", "deadbeef" * 4 + " " + "0" * 23, "passwd:'x' apikey:longenough1, Secret == q.w.e.r.t.y"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(docs_of(spark, extra, 10_000).select("doc_id", "text"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = secrets.find_secrets(docs).select("doc_id", secrets.listed(secrets.in_order("assign", "access", "hex")).alias("base"), secrets.listed(secrets.in_order(*secrets.KINDS)).alias("all"))
    for r in got.collect():
        base = brute_secrets(texts[r["doc_id"]])
        assert r["base"] == ",".join(base)
        assert set(base) <= set(r["all"].split(",")) | {""}


def test_random_tokens_are_found_and_words_are_not(spark):
    random = np.random.default_rng(7)
    symbols = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
    texts = ["see " + "".join(random.choice(symbols, 88)) + " there" for _ in range(20)] + ["internationalisation" * 3, "counterrevolutionaries_and_electroencephalographically", "x" * 60, "abcabcabcabcabcabcabcabcabcabc"]
    found = {r["doc_id"]: len(r["random"]) for r in secrets.find_secrets(docs_of(spark, texts, 0)).collect()}
    assert all(found[i] == 1 for i in range(20)) and not any(found[i] for i in range(20, 24))


@pytest.mark.parametrize("symbols,length,least", [("0123456789ABCDEF", 32, 29), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 52, 27), ("abcdefghijklmnopqrstuvwxyz0123456789", 32, 27), ("0123456789", 40, 0)])
def test_each_encoding_is_found(spark, sf_dir, symbols, length, least):
    random = np.random.default_rng(2)
    planted = docs_of(spark, ["see " + "".join(random.choice(list(symbols), length)) + " there" for _ in range(30)], 10_000)
    docs = planted.unionByName(spark.read.parquet(f"{sf_dir}/documents.parquet").select(*planted.columns))
    found = [r["doc_id"] for r in secrets.find_secrets(docs).filter("size(random) > 0").collect()]
    assert sum(i >= 10_000 for i in found) >= least and all(i >= 10_000 for i in found) and (least or not found)


def test_battery_equals_plain_statistics(spark):
    tokens = ["0123456789ABCDEF" * 2, "A1B2C3D4E5F6A7B8C9D0", "MFRGGZDFMZTWQ2LKNNWG23TPOA3X", "q7w8e9r1t2y3u4i5o6p7a8s9", "aGVsbG8gd29ybGQgdGhpcyBpcyBhIHRlc3Q", "internationalisationandmore", "x" * 24]
    docs = docs_of(spark, tokens, 0)
    text = F.col("text")
    got = {r["doc_id"]: r["b"][0] for r in docs.select("doc_id", secrets.battery(text, secrets.spans_of(text, secrets.TOKEN, 3)).alias("b")).collect()}
    below = lambda z: 1 / (1 + np.exp(-np.clip(1.5976 * z + 0.07056 * z**3, -600, 600)))
    for i, t in enumerate(tokens):
        symbols = next(s for p, s in secrets.ALPHABETS if re.search(p, t))
        n, k, x = len(t), len(symbols), np.array([symbols.index(c) + 1 for c in t], float)
        counts = np.array([t.count(c) for c in symbols])
        chi = ((counts - n / k) ** 2 / (n / k)).sum()
        free, high = k - 1, x > (k + 1) / 2
        z_chi = ((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / np.sqrt(2 / (9 * free))
        expected = 2 * high.sum() * (~high).sum() / n + 1
        spread = (expected - 1) * (expected - 2) / (n - 1)
        z_runs = (1 + (high[1:] != high[:-1]).sum() - expected) / np.sqrt(spread) if spread > 0 else 10.0
        z_serial = ((x[1:] - x.mean()) * (x[:-1] - x.mean())).sum() / n / x.var() * np.sqrt(n) if x.var() > 0 else 10.0
        assert got[i]["n"] == n and np.isclose(got[i]["p_random"], 3 * min(below(-z_chi), 2 * below(-abs(z_runs)), 2 * below(-abs(z_serial))), rtol=1e-6)
        away = n * (k * secrets.COINCIDENCE - 1)
        p_spread = below((chi - free - away) / np.sqrt(2 * (free + 2 * away))) if away > 0 else 1.0
        if k in secrets.EDGES:
            side = x > secrets.EDGES[k]
            share = min(max((side[1:] != side[:-1]).sum() / (n - 1), secrets.SWITCHES), 1 - 1e-9)
            switches = np.exp(-(n - 1) * (share * np.log(share / secrets.SWITCHES) + (1 - share) * np.log((1 - share) / (1 - secrets.SWITCHES))))
            p_spread = min(1, 3 * min(p_spread, secrets.HEX_LETTERS**n if k == 16 else 1, switches))
        assert np.isclose(got[i]["p_text"], p_spread, rtol=1e-6, atol=1e-300)


def test_redaction(spark):
    docs = docs_of(spark, ["clean text", "é token=abcdefgh end", None, "password=" + "0123456789abcdef" * 2])
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in secrets.redact_secrets(docs).collect()}
    assert got == {1: ("clean text", 10), 2: ("é [secret] end", 14), 3: (None, 0), 4: ("[secret]", 8)}


def brute_top(rows, k=5):
    vectors = [(i, np.floor(256 * np.array(v, float)).astype(np.int64)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (q, own) in enumerate(vectors):
        if q % 50 == 0:
            best = sorted((-int(own @ v), i) for m, (i, v) in enumerate(vectors) if m != n and len(v) == len(own))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("shard_bytes,query_bytes", [(top_k.SHARD_BYTES, top_k.QUERY_BYTES), (8000, 700)])
def test_top_k(spark, sf_dir, shard_bytes, query_bytes):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    same = rows[3][1]
    rows += [(10_000 + i, same) for i in range(30)] + [(20_000, None), (20_050, [1.0, None]), (20_100, [float("nan")] * 64), (20_150, [1.0, 2.0]), (20_151, [3.0, -2.0]), (30_000, []), (30_001, []), (None, same)]
    rows += [rows[0], rows[3], (rows[0][0], same), (7, same), (7, rows[1][1]), (7, same)]  # ids that repeat, with equal and other vectors
    vectors = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id long, embedding array<float>, dim int, keys int, asked string")
    got = sorted(tuple(r) for r in top_k.top_k(vectors, F.col("vec_id") % 50 == 0, shard_bytes=shard_bytes, query_bytes=query_bytes).select("query_id", "rank", "vec_id", "score").collect())
    rows = [(i, v if v is None else [None if x is None else np.float32(x) for x in v]) for i, v in rows]
    assert got == brute_top(rows)


def test_top_k_query_equals_its_sql(spark, tmp_path):
    """Ids that repeat, among queries and candidates."""
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [-3.0, 1.0]), (7, [2.0, 2.0]), (7, [0.5, 0.25]), (8, [2.0, 2.0]), (50, []), (9, []), (None, [1.0, 1.0]), (100, None), (150, [1.0, None])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    got = top_k.op9_top_k_search(spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == sorted(duck.execute(queries.ORACLES["op9_top_k_search"]).fetchall())


def test_language(spark, sf_dir):
    got = language.op5_language_id(spark, sf_dir).toPandas().merge(pandas_of(spark, sf_dir, "documents"), on="doc_id")
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.97 and got.score.between(0, 1).all() and got.rejected.mean() < 0.01
    model = language.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert model.predict(["", "123 !!", "漢字漢字漢字漢字" * 30])[0][:2] == ["und", "und"]
    assert model.predict(["", "123 !!", "漢字漢字漢字漢字" * 30])[2].all()


def test_language_vectors_equal_a_plain_loop(spark, sf_dir):
    model = language.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def plain(text):
        raw = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in text.lower().encode())
        clean, m = b" " + b" ".join(raw.split()) + b" ", [int(x) for x in language._M]
        counts = np.zeros(language.BINS)
        for i in range(len(clean) - 1 if len(clean) > 2 else 0):
            pair = (clean[i] * m[0] + clean[i + 1] * m[1]) & 0xFFFFFFFF
            counts[(pair * m[4] & 0xFFFFFFFF) >> (32 - language.BITS)] += 1
            if i + 2 < len(clean):
                counts[((pair ^ (clean[i + 2] * m[2] & 0xFFFFFFFF)) * m[3] & 0xFFFFFFFF) >> (32 - language.BITS)] += 1
        weighted = np.log1p(counts) * model.idf
        return max((float(weighted @ c / max(np.linalg.norm(weighted), 1e-9)), name) for c, name in zip(model.centroids, model.languages))

    texts = ["Der Hund und die Katze sind mit dem Kind.", "x", "the cat. THE DOG?", "les élèves à l'école", "word " * 400]
    names, scores, _ = model.predict(texts)
    for t, name, score in zip(texts, names, scores):
        assert abs(plain(t)[0] - score) < 1e-5 and plain(t)[1] == name


def auc(score, label):
    rank = score.rank()
    pos, neg = (label == 1).sum(), (label == 0).sum()
    return (rank[label == 1].sum() - pos * (pos + 1) / 2) / (pos * neg)


def held_out_scores(spark, found):
    marks = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    got = found.toPandas().merge(marks, on="doc_id")
    assert got.score.between(0, 1).all()
    return got[got.held_out]


def test_network_scores_equal_a_plain_loop():
    random = np.random.default_rng(4)
    net = quality.ByteNetwork(random.normal(0, 0.3, (quality.WIDTH, 256, quality.FILTERS)).astype(np.float32), random.normal(0, 0.3, quality.FILTERS).astype(np.float32), random.normal(0, 1, 2 * quality.FILTERS).astype(np.float32), 0.2)

    def plain(text):
        raw, step = text.encode(), quality.CHUNK - quality.OVERLAP
        chunks = [raw[a : a + quality.CHUNK] for a in range(0, max(len(raw) - quality.OVERLAP, 1), step)]
        features = []
        for c in chunks:
            padded = c + bytes(quality.CHUNK - len(c))
            places = range(max(1, min(len(c), quality.CHUNK - quality.WIDTH + 1)))
            features.append([max(0.0, net.filter_bias[f] + max(sum(net.filters[j, padded[p + j], f] for j in range(quality.WIDTH)) for p in places)) for f in range(quality.FILTERS)])
        both = np.concatenate([np.mean(features, axis=0), np.max(features, axis=0)])
        return 1 / (1 + np.exp(-(both @ net.weights + net.bias)))

    texts = ["", "a", "kurz", "word " * 20, "é漢" * 90, "x" * 64, "y" * 513, "tail" * 150]
    assert np.allclose(net.score(texts), [plain(t) for t in texts], atol=1e-4)


def test_network_gradient_step_lowers_the_loss():
    random = np.random.default_rng(0)
    draw = lambda letters: "".join(random.choice(list(letters), 300))
    rows = [(draw("abcdef "), 1) for _ in range(60)] + [(draw("#$%&ab "), 0) for _ in range(60)]
    score = quality.train(rows).score([t for t, _ in rows])
    assert score[:60].min() > 0.5 > score[60:].max()


def test_quality(spark):
    held = held_out_scores(spark, quality.op2_quality(spark, "/root/testdata/sf0.1"))
    assert auc(held.score, held.quality) > 0.98 and (held.predicted == held.quality).mean() > 0.97


def test_toxicity(spark):
    held = held_out_scores(spark, toxicity.op10_toxicity(spark, "/root/testdata/sf0.1"))
    true = (held.predicted == 1) & (held.toxic == 1)
    precision, recall = true.sum() / (held.predicted == 1).sum(), true.sum() / (held.toxic == 1).sum()
    assert auc(held.score, held.toxic) > 0.95 and precision > 0.9 and recall > 0.8


def plain_toxicity(model, text):
    """The same score, n-gram by n-gram in whole numbers."""
    def value(table, word):
        points = [1, *map(ord, word), 1]
        bins = []
        for size in toxicity.SIZES:
            for i in range(len(points) - size + 1):
                mixed = points[i] * int(toxicity._M[0]) & 0xFFFFFFFF
                for k in range(1, size):
                    mixed = (mixed ^ points[i + k]) * int(toxicity._M[k % 5]) & 0xFFFFFFFF
                bins.append(((mixed ^ (mixed >> 15)) * 2654435761 & 0xFFFFFFFF) >> (32 - toxicity.BITS))
        return float(np.mean(table[bins])) if bins else 0.0

    words = re.findall("[0-9a-z\xa1-\u1fff\u2070-\u2fff\u3001-\U0010ffff]+", text.lower())
    z = model.bias + toxicity.DENSITY * sum(value(model.density, w) for w in words) / (len(words) + toxicity.PRIOR_WORDS)
    each = [value(model.stretch, w) for w in words]
    stretches = [each[max(0, min(i + toxicity.STRETCH, len(each)) - toxicity.STRETCH) : i + toxicity.STRETCH] for i in range(len(each))]
    z += max((float(np.mean(s)) for s in stretches), default=0.0)
    return 1 / (1 + np.exp(-z))


def test_toxicity_scores_equal_a_plain_loop():
    random = np.random.default_rng(3)
    model = toxicity.ToxicityModel(*random.normal(0, 1, (2, 1 << toxicity.BITS)).astype(np.float32), -0.3)
    texts = ["", "...", "a", "one two", "Ünï 漢字 x9—y", "é" * 500, "a b c d e f g", "word " * 300, "tie tie\ntie"]
    assert np.allclose(model.score(texts), [plain_toxicity(model, t) for t in texts], atol=1e-5)


def test_misspellings_share_vectors():
    random = np.random.default_rng(0)
    plain = [" ".join(f"w{x}" for x in random.integers(0, 300, 40)) for _ in range(300)]
    rows = [(t, 0) for t in plain[:150]] + [(t + " horriblething", 1) for t in plain[150:]]
    model = toxicity.train(rows)
    clean, exact, near = model.score([plain[0], plain[1] + " horriblething", plain[2] + " horriblethng"])
    assert clean < 0.5 < near and exact > 0.5


def test_fold_figures_of_separable_rows():
    random = np.random.default_rng(1)
    rows = [(" ".join(f"w{x}" for x in random.integers(0, 200, 30)) + (" horriblething" if i % 2 else ""), i % 2) for i in range(200)]
    random.shuffle(rows)
    f1, _, precision, recall = toxicity.fold_figures([(t, int(y)) for t, y in rows], 2)
    assert f1 > 0.9 and precision > 0.9 and recall > 0.9


ODD_ROWS = [(None, None, None, None, None, 1, "x"), (1, None, "en", "s", 0, 1, "x"), (2, "", "en", "s", 0, 1, "x"), (3, "alpha beta gamma delta epsilon zeta", "en", "s", 5, None, None), (3, "alpha beta gamma delta epsilon zeta", "en", "s", 5, None, None), (4, "word " * 30_000, "en", None, 5, 0, "y"), (5, "🙂 \x00 ///", None, "s", 5, 0, "y"), (None, "alpha beta gamma delta epsilon zeta", "en", "s", 5, 2, "z")]


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    """Tables with nulls everywhere, repeated rows, a very long text and extra columns whose names the operators use themselves."""
    return write_tables(spark, tmp_path_factory.mktemp("odd"), ODD_ROWS)


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    return write_tables(spark, tmp_path_factory.mktemp("empty"), [])


def write_tables(spark, folder, rows):
    spark.createDataFrame(rows, DOCS + ", score int, own_row string").write.parquet(f"{folder}/documents.parquet")
    some = bool(rows)
    spark.createDataFrame([(1, 1, None, 5), (2, 0, 1, 5), (3, None, 0, 5), (3, None, 0, 5), (None, 1, 1, 5)] if some else [], "doc_id long, quality int, toxic int, label int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, None), (None, "alpha beta"), (2, "")] if some else [], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(0, [1.0, 2.0]), (0, [1.0, 2.0]), (None, [1.0, 1.0]), (50, None), (100, []), (7, [0.5, None])] if some else [], "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_odd_rows(spark, odd_dir, name):
    got = queries.QUERIES[name](spark, odd_dir).toPandas()
    if name.startswith("op6"):
        assert got.groupby(got.doc_id.fillna(-1)).length.sum().to_dict()[1.0] == 1 and got.groupby(["sequence_id"]).length.sum().max() <= 1024
        assert (got.start == 0).sum() == len(ODD_ROWS) and got[got.start == 0].doc_tokens.sum() == got.length.sum()
    elif name.startswith("op9"):
        assert got.values.tolist() == [[0, 1, 0, 5 * 256**2]] * 2
    elif name.startswith("op11"):
        assert len(got) == 0  # no word of six letters comes five times
    elif name.startswith("op13"):
        assert sorted(got.vec_id.fillna(-1)) == [-1, 0, 0] and set(got.component) == {1} and set(got.n) == {3} and sorted(got.deviation) == [64**2, 64**2, 128**2]
    else:
        assert len(got) == len(ODD_ROWS)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert queries.QUERIES[name](spark, empty_dir).count() == 0
