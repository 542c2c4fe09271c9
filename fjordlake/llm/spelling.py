"""Spelling variants: words that one inserted, deleted or replaced character parts, grouped under the commonest spelling.

Near words are found through an index of variable-length grams. A gram is extended, character by character, while it is frequent
among the words, so that a list of the index is short unless its gram is as long as grams get. Each word, padded at both ends, is
decomposed into the gram at each place that none before it covers. From the grams and the dictionary follows a bound of each word:
how many of its grams one edit can change at most. Two near words therefore share all but so many grams of either, which prunes
twice. Only a word's rarest grams, one more than that bound, are looked up in the lists (one of them must be shared), and where
lists merge, both words' gram sets, as bits, must differ by no more than their bounds. What is left is compared character by
character.

Rows: null and empty texts hold no words; a text of any length is taken whole; repeated documents count as often as they come, a
null doc_id never loses a character; equally frequent near words give the least in code-point order as form; an empty table gives
no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fjordlake.llm.common import documents, written

#: Lengths of grams, and so many frequent grams of each length at most, which bounds what is broadcast.
SHORTEST, LONGEST = 3, 8
MOST_FREQUENT = 50_000
#: A gram in fewer words is never extended.
LEAST_FREQUENT = 16
#: Rows of one index list that meet in one task; longer lists are split. Split lists are no more than so many, which bounds what is broadcast:
#: of more, blocks grow.
LIST_BLOCK, MOST_SPLIT = 4096, 100_000
#: Index rows carry a longer word by its SHA-256 until its rarest grams are known, since a word has a row for each gram.
LONG_WORD = 256
#: Index rows that a task hands on at a time.
ROWS_AT_ONCE = 200_000
BEGIN, END = "\x02", "\x03"

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(docs: DataFrame, min_length: int, min_count: int, lose_every: int | None = None) -> DataFrame:
    """word and n: the lower-cased runs of letters of docs (doc_id, text) that are long and frequent enough.

    lose_every: where it divides the crc32 of `<doc_id>:<run>`, the run loses the character at that checksum modulo its length."""
    run = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"({RUN})"), F.lit(1))).alias("run")).filter(F.length("run") >= min_length)
    lowered = run.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    word = F.col("run")
    if lose_every:
        h = F.crc32(F.concat_ws(":", F.col("doc_id").cast("string"), "run"))
        at = (h % F.length("run")).cast("int")
        rest = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        word = F.when(F.col("doc_id").isNotNull() & (h % lose_every == 0), rest).otherwise(word)
    counted = lowered.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter((F.length("word") >= min_length) & (F.col("n") >= min_count))


class Grams:
    """Decomposition of words by the frequent grams, those that are extended.

    pad: characters put at both ends, so many that no single edit reaches all grams of a word of min_length characters."""

    def __init__(self, frequent: set[str], min_length: int, shortest: int = SHORTEST, longest: int = LONGEST):
        self.frequent, self.shortest, self.longest = frequent, shortest, longest
        self.pad = padding(min_length, longest)
        self.endings = {g[i:] for g in frequent for i in range(1, len(g) + 1)}

    def of(self, word: str) -> tuple[list[tuple[str, int]], int]:
        """(gram, place) of each gram that none before it covers, and how many of them one edit changes at most.

        An edit changes a gram that holds its place. One to the left can also cover the gram by a longer one, but only if what lies
        between the edit and the gram's last character ends a frequent gram; one to the right changes nothing before it."""
        text = BEGIN * self.pad + word + END * self.pad
        grams, covered = [], 0
        changed = np.zeros(len(text) + 1, np.int64)
        for place in range(len(text) - self.shortest + 1):
            end = place + self.shortest
            while end < len(text) and end - place < self.longest and text[place:end] in self.frequent:
                end += 1
            if end <= covered:
                continue
            covered, first = end, place
            grams.append((text[place:end], place))
            while first > 0 and first > end - self.longest and text[first : end - 1] in self.endings:
                first -= 1
            changed[first] += 1
            changed[end] -= 1
        return grams, int(np.cumsum(changed)[self.pad : len(text) - self.pad + 1].max())


def padding(min_length: int, longest: int) -> int:
    return max(1, (2 * longest - min_length + 1) // 2)


def frequent_grams(words: DataFrame, min_length: int, shortest: int = SHORTEST, longest: int = LONGEST, most: int = MOST_FREQUENT, least: int = LEAST_FREQUENT) -> set[str]:
    """Grams below the greatest length that come often: at most `most` of each length, however many words there are."""
    pad = padding(min_length, longest)
    text = F.concat(F.lit(BEGIN * pad), "word", F.lit(END * pad))
    places = words.agg(F.sum(F.length(text))).first()[0] or 0
    padded = words.select(text.alias("text"))
    # a gram's occurrences are at most its beginning's, so that the set holds all beginnings of what it holds
    grams = None
    for q in range(shortest, longest):
        own = padded.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("text") - q + 1), lambda i: F.substring("text", i, F.lit(q)))).alias("gram"))
        grams = own if grams is None else grams.unionByName(own)
    if grams is None:
        return set()
    often = grams.groupBy("gram").agg(F.count("*").alias("n")).filter((F.col("n") > places / most) & (F.col("n") > least))
    return {r["gram"] for r in often.select("gram").collect()}


_INDEX = "key string, length int, bound int, low long, high long, token long, place int"


def _decomposed(words: DataFrame, frequent: set[str], min_length: int, shortest: int, longest: int) -> DataFrame:
    """A row for each gram and place of each word: the gram's 64-bit token, the word's bound, and as 128 bits its grams, repetitions told apart."""
    import xxhash

    names = ["key", "length", "bound", "low", "high", "token", "place"]
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(shared.value, min_length, shortest, longest)
        batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 7, kinds)], names)
        for batch in batches:
            rows: list[tuple] = []
            for word in batch.column(0).to_pylist():
                found, bound = grams.of(word)
                nth: Counter = Counter()
                tokens, bits = [], [0, 0]
                for gram, place in found:
                    nth[gram] += 1
                    own = xxhash.xxh64_intdigest(f"{gram}\x01{nth[gram]}")
                    bits[own >> 6 & 1] |= 1 << (own & 63)
                    token = own if nth[gram] == 1 else xxhash.xxh64_intdigest(f"{gram}\x011")
                    tokens.append((token - (1 << 63), place))
                low, high = (b - (1 << 64) if b >> 63 else b for b in bits)
                key = word if len(word) <= LONG_WORD else hashlib.sha256(word.encode()).hexdigest()
                rows += [(key, len(word), bound, low, high, token, place) for token, place in tokens]
                if len(rows) >= ROWS_AT_ONCE:
                    yield batch_of(rows)
                    rows = []
            yield batch_of(rows)

    return words.select("word").mapInArrow(run, _INDEX)


def near_words(words: DataFrame, min_length: int = 1, shortest: int = SHORTEST, longest: int = LONGEST, most: int = MOST_FREQUENT, list_block: int = LIST_BLOCK) -> DataFrame:
    """word and other, both ways, of all pairs of words (word) of at least min_length characters that one edit parts; a written table."""
    grams = written(_decomposed(words, frequent_grams(words, min_length, shortest, longest, most), min_length, shortest, longest), "grams")
    lists = grams.groupBy("token").agg(F.count("*").alias("listed"))
    # the rarest grams of a word, one more than an edit can change: of two near words' rarest grams at least one is common. The first that
    # the edit leaves as it is, in this order, comes after none but changed ones in either word
    nth = F.row_number().over(Window.partitionBy("key", "length").orderBy("listed", "token", "place"))
    first = written(grams.join(lists, "token").withColumn("nth", nth).filter(F.col("nth") <= F.col("bound") + 1).drop("nth", "listed"), "rarest")
    long_words = words.filter(F.length("word") > LONG_WORD).select(F.sha2("word", 256).alias("key"), "word")
    rarest = first.filter(F.col("length") <= LONG_WORD).withColumnRenamed("key", "word").unionByName(first.filter(F.col("length") > LONG_WORD).join(long_words, "key").drop("key"))
    # a list is told apart by the longer word's length: a word meets its own length and, as the shorter one, the next
    longer = rarest.withColumn("longer", F.col("length"))
    both = longer.unionByName(rarest.withColumn("longer", F.col("length") + 1))
    # lists beyond a block: one side is dealt out to blocks by word, the other goes to all of them
    list_block = max(list_block, math.ceil(2 * rarest.count() / MOST_SPLIT))
    sizes = both.groupBy("token", "longer").agg(F.count("*").alias("size")).filter(F.col("size") > list_block)
    split = sizes.select("token", "longer", F.ceil(F.col("size") / list_block).cast("int").alias("blocks"))
    one = longer.join(F.broadcast(split), ["token", "longer"], "left").withColumn("block", F.when(F.col("blocks").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("word"), "blocks")).cast("int"))
    other = both.join(F.broadcast(split), ["token", "longer"], "left").withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks") - 1, F.lit(0)))))
    a, b = one.alias("a"), other.alias("b")
    unlike = lambda x, y: F.bit_count(F.col(f"{x}.low").bitwiseAND(F.bitwise_not(F.col(f"{y}.low")))) + F.bit_count(F.col(f"{x}.high").bitwiseAND(F.bitwise_not(F.col(f"{y}.high"))))
    merges = (F.abs(F.col("a.place") - F.col("b.place")) <= 1) & ((F.col("b.length") < F.col("a.length")) | (F.col("a.word") < F.col("b.word"))) & (unlike("a", "b") <= F.col("a.bound")) & (unlike("b", "a") <= F.col("b.bound"))
    same_list = (F.col("a.token") == F.col("b.token")) & (F.col("a.longer") == F.col("b.longer")) & (F.col("a.block") == F.col("b.block"))
    pairs = a.join(b, same_list & merges & (F.levenshtein("a.word", "b.word", 1) == 1)).select(F.col("a.word").alias("word"), F.col("b.word").alias("other")).distinct()
    return written(pairs.select(F.explode(F.array(F.struct("word", "other"), F.struct(F.col("other").alias("word"), F.col("word").alias("other")))).alias("x")).select("x.*"), "near")


def spelling_variants(words: DataFrame, ratio: int = 5, min_length: int = 1, **index) -> DataFrame:
    """word, n, n_near, form (the commonest near word, if at least `ratio` times as common, else null), form_n and root, the end of the forms."""
    counted = written(words.select("word", "n"), "words")
    near = near_words(counted, min_length, **index).join(counted.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    # the least of equally common words: their order is that of bytes, and of code points
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best"))
    often = F.col("best.minus") * -1 >= F.lit(ratio) * F.col("n")
    table = written(counted.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(often, F.col("best.other")).alias("form"), F.when(often, -F.col("best.minus")).alias("form_n")), "forms")
    # each step multiplies the count, so that chains are short; each round doubles the steps taken
    most = table.agg(F.max("n")).first()[0] or 1
    steps = int(math.log(most, ratio)) + 1 if ratio > 1 else most
    ends = table.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(1, steps))))):
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        ends = written(ends.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "roots")
    return table.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(words_of(documents(spark, sf_dir), 6, 5, lose_every=199), min_length=6)
