"""Secret scans in Spark SQL expressions alone: fixed patterns, and a battery of randomness tests on long tokens.

Patterns name assigned passwords and keys, access key ids and long hexadecimal runs. The battery looks at every run of 20 or
more characters of the base-64 alphabets. Its alphabet is inferred (decimal, hexadecimal, base 32, lower-case base 36, base 62,
one of the two of base 64, or both mixed). Three tests ask whether it looks random: chi-squared uniformity over that alphabet, runs above and below the alphabet's
middle, and the serial correlation of neighbours. A token that none of them rejects is still not a finding, since short
ordinary words pass too: its p-value is that of what it shows arising from ordinary text of its length. That is an even spread
over the alphabet; for hexadecimal digits also that no other letter occurs; and for alphabets of digits and letters of one case
also how often both kinds alternate. The least of these, times their number, counts. Findings are chosen by Benjamini-Hochberg
within classes of length, so that the expected share of false ones stays below `false_share`. Decimal runs are never findings.

Rows: a null or empty text has no spans; a text of any length is scanned whole; rows with equal or null doc_ids are scanned each
for itself, equal texts alike; p-values that tie are findings together or not at all; spans that begin together are listed by
kind; an empty table gives no rows; other columns, whatever their names, are kept by `redact_secrets` and ignored elsewhere.
Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fjordlake.llm.common import documents, written

#: Fixed patterns of the three base kinds, in the order in which kinds with one start are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGNED = 6

#: Alphabets in the order in which they are tried: pattern, symbols.
ALPHABETS = (
    (r"^[0-9]+$", "0123456789"),
    (r"^[0-9a-f]+$", "0123456789abcdef"),
    (r"^[0-9A-F]+$", "0123456789ABCDEF"),
    (r"^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    (r"^[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    (r"^[0-9A-Za-z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    (r"^[0-9A-Za-z+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    (r"^[0-9A-Za-z_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    (r"", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"),
)
#: By an alphabet's size: the last symbol before digits and letters meet, for alphabets of digits and letters of one case.
EDGES = {16: 10, 32: 26, 36: 10}
#: Chance that two letters of ordinary text are equal, that a letter is one of A to F, and that a letter and a digit are neighbours.
COINCIDENCE = 0.065
HEX_LETTERS = 0.32
SWITCHES = 0.05
#: Level below which a test of the battery calls a token not random.
LEVEL = 0.001
FALSE_SHARE = 0.01
#: P-value classes for the false-discovery control: tenths of powers of ten.
P_CLASSES = 300


def _let(x: Column, f) -> Column:
    """f of x, x being evaluated once."""
    return F.element_at(F.transform(F.array(x), f), 1)


def _root(items: Column) -> Column:
    return F.greatest(F.ceil(F.sqrt(F.size(items).cast("double"))), F.lit(1)).cast("int")


def _blocks(items: Column) -> Column:
    """items in slices of about the square root of their number, so that what is built up item by item stays short."""
    return _let(_root(items), lambda k: F.transform(F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1)), k), lambda i: F.slice(items, i, k)))


_INTS = "cast(array() as array<int>)"


def _before(values: Column, combine) -> Column:
    """For each of values (whole numbers) what combine, from 0 on, makes of those before it.

    Block by block, since an array is copied with each item that is added to it."""

    def running(x: Column, first: Column) -> Column:
        nothing = F.struct(first.cast("int").alias("at"), F.expr(_INTS).alias("out"))
        return F.aggregate(x, nothing, lambda a, n: F.struct(combine(a["at"], n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])

    whole = lambda x: F.aggregate(x, F.lit(0), combine)
    return _let(_blocks(values), lambda parts: F.flatten(F.zip_with(parts, running(F.transform(parts, whole), F.lit(0)), running)))


def hits_of(text: Column, pattern: str, rank: int, keep=None) -> Column:
    """Leftmost, non-overlapping matches: start, end, the kind's rank and the matched text. keep: from group 2 to whether a match counts."""
    found = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x)).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        *((F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("group"),) if keep else ()),
    )

    def placed(x: Column) -> Column:
        lengths = F.transform(x, lambda m: m["gap"] + F.coalesce(F.char_length(m["hit"]), F.lit(0)))
        spot = lambda m, at: F.struct((at + m["gap"]).alias("start"), (at + m["gap"] + F.char_length(m["hit"])).alias("end"), F.lit(rank).alias("rank"), m["hit"].alias("hit"), (m["hit"].isNotNull() & (keep(m["group"]) if keep else F.lit(True))).alias("counts"))
        return F.filter(F.zip_with(x, _before(lengths, lambda a, n: a + n), spot), lambda m: m["counts"])

    hits = F.transform(_let(found, placed), lambda m: F.struct(*(m[c].alias(c) for c in ("start", "end", "rank", "hit"))))
    return F.when(text.rlike(pattern), hits).otherwise(F.expr("cast(array() as array<struct<start:int,end:int,rank:int,hit:string>>)"))


def spans_of(text: Column, pattern: str, rank: int, keep=None) -> Column:
    """The hits without their text."""
    return F.transform(hits_of(text, pattern, rank, keep), lambda m: F.struct(*(m[c].alias(c) for c in ("start", "end", "rank"))))


def base_spans(text: Column) -> list[Column]:
    return [spans_of(text, ASSIGN, 0, lambda group: F.char_length(group) >= LEAST_ASSIGNED), spans_of(text, ACCESS, 1), spans_of(text, HEX, 2)]


def normal_below(z: Column) -> Column:
    """Distribution function of the standard normal, by a logistic approximation within 0.0002; its tail stays positive."""
    return 1.0 / (1.0 + F.exp(-F.greatest(F.least(1.5976 * z + 0.07056 * z * z * z, F.lit(600.0)), F.lit(-600.0))))


def _two_sided(z: Column) -> Column:
    return 2 * normal_below(-F.abs(z))


def battery(text: Column, spans: Column) -> Column:
    """For each span of a text the tests' results: start, end, rank, n (length), p_random (least of the battery, corrected) and p_text."""
    return judged(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.substring(text, s["start"] + 1, s["end"] - s["start"]).alias("hit"))))


def judged(hits: Column) -> Column:
    """The same of hits, which hold their text."""
    alphabet = lambda t: F.coalesce(*(F.when(t.rlike(p), F.lit(symbols)) for p, symbols in ALPHABETS if p), F.lit(ALPHABETS[-1][1]))
    named = F.transform(hits, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.regexp_replace(s["hit"], "=+$", "").alias("t")))
    placed = F.transform(
        named,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["t"].alias("t"),
            alphabet(s["t"]).alias("symbols"),
            F.filter(F.split(s["t"], ""), lambda c: c != "").alias("chars"),
        ),
    )
    counted = F.transform(
        placed,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.size(s["chars"]).cast("double").alias("n"),
            F.char_length(s["symbols"]).cast("double").alias("k"),
            F.aggregate(F.array_distinct(s["chars"]), F.lit(0.0), lambda a, c: a + F.pow(F.char_length(s["t"]) - F.char_length(F.replace(s["t"], c, F.lit(""))), F.lit(2.0))).alias("squares"),
            F.transform(s["chars"], lambda c: F.instr(s["symbols"], c).cast("double")).alias("index"),
        ),
    )

    def moments(s: Column) -> Column:
        """One pass over neighbours: runs, places above the middle, and sums for the correlation."""
        zero = F.struct(F.lit(None).cast("double").alias("last"), *(F.lit(0.0).alias(c) for c in ("runs", "switches", "high", "x", "xx", "xy")))
        middle = (s["k"] + 1) / 2
        edge = F.coalesce(*(F.when(s["k"] == k, F.lit(float(e))) for k, e in EDGES.items()), F.lit(0.0))

        def step(a: Column, v: Column) -> Column:
            turn = F.when(a["last"].isNull() | ((a["last"] > middle) != (v > middle)), 1.0).otherwise(0.0)
            return F.struct(
                v.alias("last"),
                (a["runs"] + turn).alias("runs"),
                (a["switches"] + F.when((a["last"] > edge) != (v > edge), 1.0).otherwise(0.0)).alias("switches"),
                (a["high"] + (v > middle).cast("double")).alias("high"),
                (a["x"] + v).alias("x"),
                (a["xx"] + v * v).alias("xx"),
                (a["xy"] + F.coalesce(a["last"] * v, F.lit(0.0))).alias("xy"),
            )

        return F.aggregate(s["index"], zero, step)

    summed = F.transform(counted, lambda s: F.struct(*(s[c].alias(c) for c in ("start", "end", "n", "k", "squares")), F.element_at(s["index"], 1).alias("first"), moments(s).alias("m")))

    def tested(s: Column) -> Column:
        n, k, m = s["n"], s["k"], s["m"]
        chi = k / n * s["squares"] - n
        free = k - 1
        # Wilson and Hilferty's cube root makes chi-squared nearly normal
        z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        low = n - m["high"]
        expected = 2 * m["high"] * low / n + 1
        spread = (expected - 1) * (expected - 2) / F.greatest(n - 1, F.lit(1.0))
        z_runs = F.when(spread > 0, (m["runs"] - expected) / F.sqrt(spread)).otherwise(F.lit(10.0))
        variance = m["xx"] / n - F.pow(m["x"] / n, F.lit(2.0))
        mean = m["x"] / n
        lagged = (m["xy"] - mean * (2 * m["x"] - s["first"] - m["last"]) + (n - 1) * mean * mean) / n
        z_serial = F.when(variance > 0, lagged / variance * F.sqrt(n)).otherwise(F.lit(10.0))
        random = F.least(normal_below(-z_chi), _two_sided(z_runs), _two_sided(z_serial)) * 3
        # ordinary text: chi-squared with a non-centrality that grows with the length
        away = n * (k * COINCIDENCE - 1)
        p_spread = F.when(away > 0, normal_below((chi - free - away) / F.sqrt(2 * (free + 2 * away)))).otherwise(F.lit(1.0))
        p_letters = F.when(k == 16, F.pow(F.lit(HEX_LETTERS), n)).otherwise(F.lit(1.0))
        # Chernoff's bound on so many switches or more
        share = F.greatest(F.least(m["switches"] / F.greatest(n - 1, F.lit(1.0)), F.lit(1 - 1e-9)), F.lit(SWITCHES))
        divergence = share * F.log(share / SWITCHES) + (1 - share) * F.log((1 - share) / (1 - SWITCHES))
        p_switches = F.when(k.isin(*(float(x) for x in EDGES)), F.exp(-(n - 1) * divergence)).otherwise(F.lit(1.0))
        p_text = F.when(k == 10, F.lit(1.0)).when(k.isin(*(float(x) for x in EDGES)), F.least(F.lit(1.0), 3 * F.least(p_spread, p_letters, p_switches))).otherwise(p_spread)
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(KINDS.index("random")).alias("rank"), n.alias("n"), random.alias("p_random"), p_text.alias("p_text"))

    return F.transform(summed, tested)


def _length_class(n: Column) -> Column:
    return F.floor(F.log2(F.greatest(n, F.lit(1.0)))).cast("int")


def _p_class(p: Column) -> Column:
    """The larger, the smaller the p-value."""
    return F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * 10), F.lit(P_CLASSES)).cast("int")


def discovery_limits(counts: list[tuple[int, int, int]], false_share: float) -> dict[int, int]:
    """Benjamini-Hochberg in classes: from (length class, p class, tokens) to the least p class that counts as a finding."""
    limits = {}
    for length in {c[0] for c in counts}:
        by_class = sorted(((p, n) for own, p, n in counts if own == length), reverse=True)
        total, reached = sum(n for _, n in by_class), 0
        for p, n in by_class:
            reached += n
            if 10 ** (-p / 10) <= false_share * reached / total:
                limits[length] = p
    return limits


def find_secrets(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), false_share: float = FALSE_SHARE) -> DataFrame:
    """The columns `keep` of each row of docs, assign, access, hex and random: spans (start, end, rank) of each kind.

    Spans and the tokens' results are written once; a count of tokens by classes of length and p-value, a bounded table, then sets
    the limits that choose among them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # access ids and hexadecimal runs lie whole in tokens: what a pattern names is no finding of the battery
    result = lambda x, m: F.struct(*(x[c].alias(c) for c in ("start", "end", "rank")), _length_class(x["n"]).alias("length"), F.when(x["p_random"] > LEVEL, _p_class(x["p_text"])).otherwise(F.lit(0)).alias("p"), m["hit"].rlike(f"{ACCESS}|{HEX}").alias("named"))
    kept = _let(hits_of(F.col("text"), TOKEN, KINDS.index("random")), lambda hits: F.zip_with(judged(hits), hits, result))
    rows = docs.select(*keep, text.alias("text")).select(*keep, *(s.alias(k) for s, k in zip(base_spans(F.col("text")), KINDS)), kept.alias("tokens"))
    scanned = written(rows, "spans")
    counts = scanned.select(F.explode("tokens").alias("x")).groupBy("x.length", "x.p").agg(F.count("*").alias("n")).collect()
    limits = discovery_limits([(r["length"], r["p"], r["n"]) for r in counts], false_share)

    def is_finding(x: Column) -> Column:
        own = F.lit(None).cast("int")
        for length, p in sorted(limits.items()):
            own = F.when(x["length"] == length, F.lit(p)).otherwise(own)
        return F.coalesce(~x["named"] & (x["p"] > 0) & (x["p"] >= own), F.lit(False))

    spans = F.transform(F.filter("tokens", is_finding), lambda x: F.struct(*(x[c].alias(c) for c in ("start", "end", "rank"))))
    return scanned.select(*keep, *KINDS[:3], spans.alias("random"))


def in_order(*kinds: str) -> Column:
    """Spans of several kinds by start, then kind."""
    return F.array_sort(F.transform(F.concat(*kinds), lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"))))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact_secrets(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """docs with each secret in text replaced by the mark; n_chars, where there is one, follows. Texts without one stay as they are."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("own_row"), "text")
    found = find_secrets(rows, keep=("own_row",))
    text = F.col("own_row.text")
    spans = in_order(*KINDS)

    def cleaned(own: Column) -> Column:
        """Text between spans and marks; a span that begins in one before it adds nothing. Blocks of spans share a piece of the text, so that no span counts characters from its beginning."""
        ends = F.transform(own, lambda s: s["end"])
        placed = F.zip_with(own, _before(ends, lambda a, e: F.greatest(a, e)), lambda s, before: F.struct(before.alias("before"), s["start"].alias("start")))

        def block(b: Column) -> Column:
            base = F.element_at(b, 1)["before"]
            piece = F.substring(text, base + 1, F.greatest(F.element_at(b, -1)["start"] - base, F.lit(0)))
            part = lambda p: F.array_join(F.transform(b, lambda s: F.when(s["start"] >= s["before"], F.concat(F.substring(p, s["before"] - base + 1, s["start"] - s["before"]), F.lit(mark))).otherwise("")), "")
            return _let(piece, part)

        return F.concat(F.array_join(_let(placed, lambda p: F.transform(_blocks(p), block)), ""), F.substring(text, F.array_max(ends) + 1, F.char_length(text)))

    clean = F.when(F.size(spans) > 0, _let(spans, cleaned))
    columns = {"text": F.coalesce(clean, text)}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(clean.isNotNull(), F.char_length(clean).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("own_row.n_chars"))
    return found.select(*(columns.get(c, F.col(f"own_row.`{c}`")).alias(c) for c in docs.columns))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(listed(in_order(*KINDS[:3])), 256).alias("base_sha256"),
        listed(in_order(*KINDS)).alias("spans"),
    )
