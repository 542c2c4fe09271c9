"""Encoding and decoding with byte-pair vocabularies that mark word ends, exactly as the tokenizers library does.

The words that the corpus uses most are compiled, with their ids, into a minimal acyclic transducer (`lexicon`). Its file lies in the
shared folder; Spark brings it to each executor once, where all Python workers map the same pages. A worker cuts texts into words as
the vocabulary's own rules say, looks the distinct words of a slice up in the automaton together, and merges those it lacks pair by
pair, the lowest rank first and of equal ones the leftmost.

Vocabularies: BPE without dropout, unknown or fallback pieces. Their rules for normalizing and cutting are read from their file; texts
of Latin letters take a short way that gives the same, all others go through the library's own rules. The strings of added tokens
that a text holds are those tokens.

Rows: null and empty texts have no ids; a text of any length is encoded whole, and a word of any length is merged in about the time
of sorting it; repeated rows are rows of their own, ties have no part; an empty table gives no rows; other columns, whatever their
names, are ignored by the query.
"""

from __future__ import annotations

import heapq
import json
import math
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fjordlake.llm.common import blocks_by_size, documents, file_for_tasks, kept, kept_and, small_batches, texts_of, written
from fjordlake.llm.lexicon import Lexicon, compiled

#: Words in the lexicon, and bytes of one, which bound what the driver compiles.
MOST_WORDS, MOST_BYTES = 262_144, 64
#: Words that the lexicon lacks whose ids a worker keeps, twice over.
KEPT_WORDS = 60_000
#: Symbols up to which the next pair to merge is searched, not taken from a heap.
FEW = 24
#: Characters that normalize one by one, and whose classes no edition of Unicode has changed.
LATIN = "\x00-ɏ‐-‧€"
OTHERS = re.compile(f"[^{LATIN}]")
#: White space by the Unicode property, which is what the vocabularies' rules mean.
SPACE = r"\t-\r \x85\xa0  -     　"


class WordRules:
    """What a vocabulary's file says: symbols, ranks of pairs, and how texts become words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model = said["model"]
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback", "continuing_subword_prefix", "ignore_merges")):
            raise ValueError("only plain BPE vocabularies are supported")
        self.library = Tokenizer.from_file(path)
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in said["added_tokens"]):
            raise ValueError("only added tokens that stand as they are, are supported")
        names = {i: s for s, i in (self.vocab | self.special).items()}
        self.pieces = pa.array([names.get(i) for i in range(max(names) + 1)], pa.string())
        self.plain_decoder = said["decoder"] is None
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        # each byte as the character that stands for it: itself where it can be seen, else one of those from 256 on
        seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        hidden = iter(range(256, 512))
        self.letters = {b: chr(b if b in seen else next(hidden)) for b in range(256)}
        self.inner = [self.vocab.get(self.letters[b]) for b in range(256)]
        self.last = [self.vocab.get(self.letters[b] + self.suffix) for b in range(256)]
        self.to_bytes = {c: b for b, c in self.letters.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.short_way = self._short_way(said)

    @staticmethod
    def _short_way(said: dict):
        """The pattern of words, if the rules are: compose, white space as blanks, lower case; the words that a pattern finds, as bytes."""
        normal, cuts = said.get("normalizer") or {}, said.get("pre_tokenizer") or {}
        steps = [(n.get("type"), n.get("content")) for n in normal.get("normalizers", ())]
        own = cuts.get("pretokenizers", ())
        fits = steps == [("NFC", None), ("Replace", " "), ("Lowercase", None)] and len(own) == 2 and own[0].get("invert") and own[0].get("behavior") == "Removed" and own[1].get("type") == "ByteLevel" and not own[1].get("use_regex") and not own[1].get("add_prefix_space")
        if not fits or normal["normalizers"][1]["pattern"] != {"Regex": r"\s+"} or "Regex" not in own[0]["pattern"]:
            return None
        pattern = own[0]["pattern"]["Regex"]
        # the classes spelled out for the characters of the short way, lower-cased ones included
        reach = regex.findall(f"[{LATIN}]", "".join(map(chr, range(0x3000))))
        for name in (r"\p{L}", r"\p{N}"):
            members = "".join(re.escape(c) for c in sorted({*reach, *"".join(reach).lower()}) if regex.match(name, c))
            pattern = pattern.replace(f"[{name}]", f"[{members}]").replace(name, members)
        pattern = pattern.replace(r"[^\s", f"[^{SPACE}")
        return None if r"\s" in pattern or r"\p" in pattern else re.compile(pattern)

    def words(self, text: str) -> list[str]:
        """A text's words and added tokens in order."""
        if self.cut is None or not ("<" in text or any(s[:1] != "<" for s in self.special)):
            return self._plain_words(text)
        out: list[str] = []
        for piece in self.cut.split(text):
            if piece in self.special:
                out.append(piece)
            elif piece:
                out += self._plain_words(piece)
        return out

    def _plain_words(self, text: str) -> list[str]:
        if self.short_way is not None and (text.isascii() or not OTHERS.search(text)):
            return self.short_way.findall(text.lower())
        normal = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
        found = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(self.to_bytes[c] for c in piece).decode("utf-8") for piece, _ in found]

    def merged(self, word: str) -> tuple[int, ...]:
        """A word's ids."""
        if word in self.special:
            return (self.special[word],)
        raw = word.encode("utf-8")
        if not raw:
            return ()
        ids = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        return tuple(self._merge_few(ids) if len(ids) <= FEW else self._merge_many(ids))

    def _merge_few(self, ids: list[int]) -> list[int]:
        ranks, none = self.ranks, (math.inf, -1)
        pairs = [ranks.get(p, none) for p in zip(ids, ids[1:])]
        while pairs:
            best = min(pairs)
            if best is none:
                break
            i = pairs.index(best)
            ids[i : i + 2] = [best[1]]
            del pairs[i]
            if i:
                pairs[i - 1] = ranks.get((ids[i - 1], ids[i]), none)
            if i < len(pairs):
                pairs[i] = ranks.get((ids[i], ids[i + 1]), none)
        return ids

    def _merge_many(self, ids: list[int]) -> list[int]:
        """The same by a heap of pairs over a linked list, so that the time of a long word does not grow with its square."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*self.ranks[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.ranks]
        heap = [(rank, i, new) for rank, new, i in heap]
        heapq.heapify(heap)
        while heap:
            rank, i, new = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or self.ranks.get((ids[i], ids[j])) != (rank, new):
                continue  # one of the two has been merged since
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if found := self.ranks.get((new, ids[after[i]])):
                    heapq.heappush(heap, (found[0], i, found[1]))
            if before[i] >= 0 and (found := self.ranks.get((ids[before[i]], new))):
                heapq.heappush(heap, (found[0], before[i], found[1]))
        return [x for x in ids if x >= 0]

    def decoded(self, lists: pa.Array) -> pa.Array:
        """The texts of lists of ids as the library gives them, special tokens among them; without a decoder that is the pieces with blanks between them."""
        if not self.plain_decoder:
            return pa.array([None if ids is None else self.library.decode([i for i in ids if i is not None], skip_special_tokens=False) for ids in lists.to_pylist()], pa.string())
        ids = pc.if_else(pc.and_(pc.greater_equal(lists.flatten(), 0), pc.less(lists.flatten(), len(self.pieces))), lists.flatten(), None)
        pieces = self.pieces.take(ids)
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        known = pieces.is_valid().to_numpy(zero_copy_only=False)
        before = np.concatenate(([0], np.cumsum(known)))
        ends = before[np.concatenate(([0], np.cumsum(counts)))]
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pieces.drop_null()), " ")
        return pc.if_else(lists.is_valid(), joined, None)


class WordCodec:
    """Encodes texts with a lexicon and, for what it lacks, by merging."""

    def __init__(self, path: str, lexicon: Lexicon | None, most: int = KEPT_WORDS):
        self.rules, self.lexicon, self.most = WordRules(path), lexicon, most
        self.merged: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}  # the last full one; what is used of it again moves on

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each text has, and all their ids one behind the other."""
        found = [self.rules.words(t) for t in texts]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        coded = pa.array(list(chain.from_iterable(found)), pa.string()).dictionary_encode()
        del found
        counts, ids = self._ids_of(coded.dictionary.to_pylist())
        own = coded.indices.to_numpy(zero_copy_only=False)
        each = counts[own]
        ends = np.cumsum(each)
        # the ids' places: each word's begin, and how far in the word an id is
        place = np.arange(int(each.sum())) - np.repeat(ends - each - (np.cumsum(counts) - counts)[own], each)
        per_text = np.diff(np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(sizes)))])
        return per_text, ids[place]

    def _ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.lexicon is None:
            found = [self.rules.merged(w) for w in words]
            return np.fromiter(map(len, found), np.int64, len(found)), np.fromiter((i for f in found for i in f), np.int64)
        known, counts, ids = self.lexicon.look_up([w.encode("utf-8") for w in words])
        missing = np.flatnonzero(~known).tolist()
        if not missing:
            return counts, ids
        merged = [self._merged(words[k]) for k in missing]
        lengths = np.fromiter(map(len, merged), np.int64, len(merged))
        tail = np.fromiter((i for m in merged for i in m), np.int64, int(lengths.sum()))
        # the automaton's ids come first, then the merged ones: bring them in the words' order
        all_counts = counts.copy()
        all_counts[missing] = lengths
        begin = np.cumsum(all_counts) - all_counts
        out = np.empty(int(all_counts.sum()), np.int64)
        from_merge = np.repeat(~known, all_counts)
        out[from_merge], out[~from_merge] = tail, ids
        return all_counts, out


    def _merged(self, word: str) -> tuple[int, ...]:
        own = self.merged.get(word)
        if own is None:
            own = self.older.get(word) or self.rules.merged(word)
            if len(self.merged) >= self.most:
                self.older, self.merged = self.merged, {}
            self.merged[word] = own
        return own


def word_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """word and n of all texts of docs (text), cut as the vocabulary says."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = kept(("words", tokenizer), lambda: WordRules(tokenizer))
        for batch in small_batches(batches, 0, keeps=True):
            words = pa.array(list(chain.from_iterable(map(rules.words, texts_of(batch.column(0))))), pa.string()).dictionary_encode()
            n = np.bincount(words.indices.to_numpy(zero_copy_only=False), minlength=len(words.dictionary))
            yield pa.RecordBatch.from_arrays([words.dictionary, pa.array(n, pa.int64())], ["word", "n"])

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int = MOST_WORDS, most_bytes: int = MOST_BYTES) -> DataFrame:
    """The most frequent words of counts (word, n), no more than `most`: all from a count on, of counts an eighth of a doubling apart."""
    level = F.floor(F.log2("n") * 8).cast("int")
    short = written(counts.filter(F.octet_length("word") <= most_bytes).withColumn("level", level), "word-counts")
    total, lowest = 0, None
    for r in sorted(short.groupBy("level").agg(F.count("*").alias("n")).collect(), reverse=True):
        if total + r["n"] > most:
            break
        total, lowest = total + r["n"], r["level"]
    return short.filter(F.lit(False) if lowest is None else F.col("level") >= lowest).select("word")


def build_lexicon(words: DataFrame, tokenizer: str) -> str:
    """Compiles words (word), each merged where it lies, with their ids and gives Spark the file to bring to executors; its name there."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = kept(("words", tokenizer), lambda: WordRules(tokenizer))
        for batch in batches:
            own = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_pydict({"word": [w.encode("utf-8") for w in own], "ids": pa.array([np.array(rules.merged(w), "<i4").tobytes() for w in own], pa.binary())}, schema=pa.schema([("word", pa.binary()), ("ids", pa.binary())]))

    merged = words.select("word").distinct().mapInArrow(merge, "word binary, ids binary").toArrow()
    data = compiled(sorted((w, tuple(np.frombuffer(ids, "<i4").tolist())) for w, ids in zip(merged.column(0).to_pylist(), merged.column(1).to_pylist())))
    return file_for_tasks(words.sparkSession, "lexicon", data.tobytes())


def _codec(tokenizer: str, name: str | None) -> WordCodec:
    return kept(("codec", tokenizer, name), lambda: WordCodec(tokenizer, Lexicon.mapped(SparkFiles.get(name)) if name else None))


def encode(docs: DataFrame, tokenizer: str, keep: tuple[str, ...] = ("doc_id",), most_words: int = MOST_WORDS, and_decode: bool = False) -> DataFrame:
    """The columns `keep` of docs and ids of their texts, an array; and_decode: also `decoded`, what `decode` makes of the ids, by the same workers."""
    name = build_lexicon(frequent_words(word_counts(docs, tokenizer), most_words), tokenizer)
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(tokenizer, name)
        for batch in small_batches(batches, n, keeps=True):
            counts, ids = codec.encode_all(texts_of(batch.column(n)))
            ends = np.concatenate(([0], np.cumsum(counts)))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            more = [codec.rules.decoded(lists)] if and_decode else []
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], lists, *more], [*keep, "ids", *(["decoded"] if and_decode else [])])

    return docs.select(*keep, "text").mapInArrow(run, kept_and(docs, keep, "ids array<int>, decoded string" if and_decode else "ids array<int>"))


def slices(batch: pa.RecordBatch, column: int, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose lists in a column hold about `most` entries; a longer one stands alone."""
    for part in blocks_by_size(pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_pylist(), most):
        yield batch.slice(part.start, part.stop - part.start)


def decode(coded: DataFrame, tokenizer: str) -> DataFrame:
    """All columns of coded, where `ids` is an array, and `decoded`, their text; ids of no piece are left out, null ids give null."""
    columns = coded.columns
    at = columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = kept(("words", tokenizer), lambda: WordRules(tokenizer))
        for batch in batches:
            for part in slices(batch, at):
                yield pa.RecordBatch.from_arrays([*part.columns, rules.decoded(part.column(at))], [*columns, "decoded"])

    return coded.mapInArrow(run, T.StructType([*coded.schema.fields, T.StructField("decoded", T.StringType())]))


def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    both = encode(documents(spark, sf_dir), path, and_decode=True)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
