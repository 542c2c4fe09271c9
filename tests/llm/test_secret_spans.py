"""Long tokens, many matches and false-discovery control of the secret scans."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fjordlake.llm import secrets
from tests.llm.test_operators import brute_secrets, docs_of

B62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


@pytest.fixture(scope="module")
def planted(spark, sf_dir):
    random, kinds = np.random.default_rng(0), {"base 62": B62, "base 64": B62 + "+/", "base 64 of addresses": B62 + "-_"}
    rows = [(name, n, "see " + "".join(random.choice(list(s), n)) + " there") for name, s in kinds.items() for n in (24, 40, 64, 256, 512, 1000, 1500, 3000, 6000) for _ in range(12)]
    own = docs_of(spark, [r[2] for r in rows], 10**6)
    docs = own.unionByName(spark.read.parquet(f"{sf_dir}/documents.parquet").select(*own.columns))
    return rows, [r["doc_id"] for r in secrets.find_secrets(docs).filter("size(random) > 0").collect()]


def test_long_tokens_are_found(planted):
    rows, found = planted
    each = {}
    for i, (name, n, _) in enumerate(rows):
        each[name, n] = each.get((name, n), 0) + (10**6 + i in found)
    assert min(each.values()) >= 11 and all(i >= 10**6 for i in found), each


def test_many_matches_lie_where_plain_matching_finds_them(spark):
    random = np.random.default_rng(1)
    parts = ["token=abcdefgh", "AKIA" + "B2" * 9, "é🙂", "0123456789abcdef" * 2, "password: x", " ", "secret='" + "q" * 7 + "'"]
    texts = ["".join(random.choice(parts, n)) for n in (0, 1, 2, 3, 4, 5, 8, 9, 10, 99, 100, 101, 3000)]
    got = {r["doc_id"]: r["base"] for r in secrets.find_secrets(docs_of(spark, texts, 0)).select("doc_id", secrets.listed(secrets.in_order("assign", "access", "hex")).alias("base")).collect()}
    assert got == {i: ",".join(brute_secrets(t)) for i, t in enumerate(texts)} and got[12].count(",") > 1000


def test_redaction_of_many_spans_equals_a_plain_loop(spark):
    random = np.random.default_rng(2)
    parts = ["token=abcdefgh", "token=" + "0123456789abcdef" * 2, "é🙂", "AKIA" + "B2" * 9, " x ", "secret: AKIA" + "C3" * 10]
    texts = ["".join(random.choice(parts, n)) for n in (1, 2, 7, 50, 700)]
    for r in secrets.redact_secrets(docs_of(spark, texts, 0)).collect():
        text, out, at = texts[r["doc_id"]], "", 0
        for _, start, end in (s.split(":") for s in brute_secrets(text)):
            start, end = int(start), int(end)
            out += text[at:start] + "[secret]" if start >= at else ""
            at = max(at, end)
        out += text[at:]
        assert re.sub(r"\[secret\]", "", r["text"]) == re.sub(r"\[secret\]", "", out) and r["text"] == out and r["n_chars"] == len(out)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 10, 17])
def test_running_values(spark, n):
    values = [int(x) for x in np.random.default_rng(n).integers(-9, 9, n)]
    row = spark.createDataFrame([(values,)], "v array<int>").select(secrets._before(F.col("v"), lambda a, x: a + x).alias("sums"), secrets._before(F.col("v"), lambda a, x: F.greatest(a, x)).alias("most")).collect()[0]
    assert row["sums"] == [sum(values[:i]) for i in range(n)] and row["most"] == [max([0, *values[:i]]) for i in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_limits_are_benjamini_and_hochberg(seed):
    """Plain Benjamini-Hochberg over single p-values, those of a class all as its upper bound."""
    random = np.random.default_rng(seed)
    tokens = [(int(random.integers(4, 7)), int(random.choice([0, 0, 0, *range(1, 60)]))) for _ in range(300)]
    limits = secrets.discovery_limits([(*t, tokens.count(t)) for t in set(tokens)], 0.05)
    for length in {t[0] for t in tokens}:
        values = sorted(10 ** (-p / 10) for own, p in tokens if own == length)
        passing = [v for k, v in enumerate(values, 1) if v <= 0.05 * k / len(values)]
        found = {p for own, p in tokens if own == length and length in limits and p >= limits[length]}
        assert found == {p for own, p in tokens if own == length and passing and 10 ** (-p / 10) <= max(passing)}
