"""N-gram Jaccard join: documents whose sets of word 5-grams have a Jaccard similarity of 0.8 or more.

1. Each text becomes its set of hashed 5-grams of lower-cased words between white space (all words, if fewer). Texts with one
   set form a class, represented by its least doc_id; all further work is on representatives.
2. MinHash banding: rows a band are fixed, and bands are as many as the target recall at the threshold needs. Classes are
   shuffled on band hashes; each is tied to the least of its bucket, and these ties' connected components hold every pair of
   classes that share a band. No pair is written out. Components too large for one task are banded anew with more rows a band,
   which keeps the recall but parts chains of loosely similar texts.
3. Each component's texts meet in one task, or, if it is still too large, which takes that many texts that are nearly alike, in one
   task for each pair of its blocks, bounded by bytes and by classes. There every pair is verified on the full n-gram sets, tile by
   tile, by counting shared n-grams for all pairs of a tile at once. A task returns for each class its number of linked documents
   and one tie to its part of the task's link graph, never the pairs.
4. Connected components of those ties are the groups. Wherever many rows share one key (a star's centre, a bucket, a text with
   many copies), the key's facts come by broadcast, with a bound on the number of such keys, and its rows are spread.

Rows: a row for each row with a doc_id; rows that share one are compared each by its own text, and of equal ones, or ties for
a group's least doc_id, the one whose text has the least hash comes first; a row with a null doc_id takes no part and comes out with class_id
null and n_links 0; null, empty and wordless texts have no n-grams and no links; a text of any length takes part whole, and alone
in a block if it is larger than one; an empty table gives no rows; other columns, whatever their names, are ignored by
`near_duplicates` and kept by `one_of_each`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fjordlake.llm.common import as_rows, blocks_by_size, documents, join_hot, small_batches, texts_of, written

WORDS = 5
THRESHOLD = 0.8
ROWS = 5
RECALL = 0.9999
#: Classes, and bytes of n-gram sets, that meet in one task; a component with more is banded anew, then cut into blocks of about so many.
BLOCK = 1024
BLOCK_BYTES = 8 << 20
#: Rows a band for components that are larger than a block.
FINE_ROWS = 10
#: Classes of a tile, whose pairs are verified at once.
TILE = 384

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def bands_for(threshold: float, rows: int, recall: float) -> int:
    """Bands so that a pair at the threshold shares one with probability `recall` at least."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def n_gram_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """The sorted, distinct 64-bit hashes of each text's word n-grams."""
    out: list[np.ndarray] = []
    for part in blocks_by_size([len(t) for t in texts], 8_000_000):
        clean = pc.utf8_trim_whitespace(pc.utf8_lower(pa.array(texts[part], pa.string())))
        lists = pc.utf8_split_whitespace(clean)
        coded = pc.dictionary_encode(lists.flatten())
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
        flat = hashes[coded.indices.to_numpy(zero_copy_only=False)] if len(hashes) else np.zeros(0, np.uint64)
        bounds = lists.offsets.to_numpy()
        empty = (pc.binary_length(clean).to_numpy(zero_copy_only=False) == 0).tolist()
        grams = np.zeros(max(len(flat) - words + 1, 0), np.uint64)
        for k in range(words):
            grams += (flat[k : k + len(grams)] + np.uint64(k + 1)) * _MIX[k % 5]
        grams = _spread(grams)
        for i, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
            if empty[i]:
                out.append(np.zeros(0, np.uint64))
            elif b - a < words:
                out.append(np.array([xxhash.xxh64_intdigest(flat[a:b].tobytes())], np.uint64))
            else:
                out.append(np.unique(grams[a : b - words + 1]))
    return out


def _spread(x: np.ndarray) -> np.ndarray:
    """A fixed bijective mixing of 64 bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def band_hashes(grams: np.ndarray, factors: np.ndarray, rows: int) -> list[int]:
    """MinHash over all n-grams, and a signed 64-bit hash of each band of it."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 2048):
        least = np.minimum(least, (grams[None, at : at + 2048] * factors[:, None]).min(axis=1))
    bands = least.reshape(-1, rows)
    mixed = np.zeros(len(bands), np.uint64)
    for k in range(rows):
        mixed = _spread(mixed * np.uint64(31) + bands[:, k])
    return mixed.view(np.int64).tolist()


def _factors(n: int) -> np.ndarray:
    return np.random.default_rng(8).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(docs: DataFrame, words: int, rows: int, bands: int) -> DataFrame:
    """doc_id, key (128-bit hash of the n-gram set; null without n-grams), grams (the set's size) and bands of each row of docs (doc_id, text); a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _factors(rows * bands)
        for batch in small_batches(batches, 1):
            keys, found, sizes = [], [], []
            for grams in n_gram_sets(texts_of(batch.column(1)), words):
                keys.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
                sizes.append(len(grams))
                found.append(band_hashes(grams, factors, rows) if len(grams) else [])
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "key": pa.array(keys, pa.binary()), "grams": pa.array(sizes, pa.int64()), "bands": pa.array(found, pa.list_(pa.int64()))})

    return written(docs.mapInArrow(run, "doc_id long, key binary, grams long, bands array<long>"), "signatures")


def connected_components(edges: DataFrame) -> DataFrame:
    """node and component (its least node) for each node of edges (a, b), by alternating large and small stars.

    Each round is a written table; no node's neighbours are ever gathered in one place."""
    edges = written(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"), F.count("*").alias("n"))
        large = join_hot(both, least, ["a"], "b", 2 * edges.count()).filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b")).filter(F.col("a") != F.col("b")).distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(small_least, "a").select(F.explode(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("e")).select("e.a", "e.b")
        edges = written(small.filter(F.col("a") != F.col("b")).distinct(), "edges")
        nodes = edges.groupBy("a").agg(F.count("*").alias("n"))
        # done when each node has one tie and none of those tied to is tied further
        if nodes.filter(F.col("n") > 1).isEmpty() and edges.select(F.col("b").alias("a")).distinct().join(nodes, "a", "left_semi").isEmpty():
            break
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _shared_counts(sets: list[np.ndarray], left: int) -> np.ndarray:
    """Numbers of shared n-grams between the first `left` sets and all sets."""
    sizes = [len(s) for s in sets]
    owner = np.repeat(np.arange(len(sets)), sizes)
    grams, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = count > 1
    number = np.cumsum(often) - 1
    keep = often[inverse]
    owner, gram = owner[keep], number[inverse[keep]]
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    out = np.zeros((left, len(sets)), np.float32)
    total = int(often.sum())
    for at in range(0, total, 4096):
        a, b = np.searchsorted(gram, (at, at + 4096))
        present = np.zeros((len(sets), min(4096, total - at)), np.float32)
        present[owner[a:b], gram[a:b] - at] = 1
        out += present[:left] @ present.T
    return out


def _least_in_parts(linked: np.ndarray) -> np.ndarray:
    """For each node of a symmetric link matrix the least node that links lead to."""
    root = np.arange(len(linked))
    while True:
        new = np.minimum(root, np.where(linked, root[None], len(linked)).min(axis=1, initial=len(linked)))
        if (new == root).all():
            return root
        root = new


def verified(ids: np.ndarray, sides: np.ndarray, copies: np.ndarray, texts: list[str], words: int, threshold: float, tile: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """For each class: the least class that links lead to, and the number of linked documents of other classes.

    sides: all 0 to compare all with all, else 0 or 1 to compare across only."""
    sets = n_gram_sets(texts, words)
    sizes = np.array([len(s) for s in sets], np.float32)
    n_links = np.zeros(len(ids), np.int64)
    order = np.argsort(ids, kind="stable")
    above = np.empty(len(ids), np.int64)  # a forest by rank of id, each tree's root being its least
    above[:] = np.arange(len(ids))
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))

    def top(x: int) -> int:
        while above[x] != x:
            above[x] = above[above[x]]
            x = int(above[x])
        return x

    groups = [np.flatnonzero(sides == side) for side in (0, 1)] if sides.any() else [np.arange(len(ids))] * 2
    tiles = [[g[at : at + tile] for at in range(0, len(g), tile)] for g in groups]
    for i, left in enumerate(tiles[0]):
        for right in tiles[1] if sides.any() else tiles[1][i:]:
            same = left is right or (not sides.any() and left[0] == right[0])
            both = left if same else np.concatenate([left, right])
            shared = _shared_counts([sets[x] for x in both], len(left))
            linked = np.zeros((len(both), len(both)), bool)
            linked[: len(left)] = shared >= threshold * (sizes[left, None] + sizes[both][None] - shared) - 1e-4
            if not same:
                linked[: len(left), : len(left)] = False
            linked |= linked.T
            np.fill_diagonal(linked, False)
            n_links[both] += linked @ copies[both]
            parts = _least_in_parts(linked)
            for x in np.flatnonzero(parts != np.arange(len(both))).tolist():
                a, b = top(int(rank[both[x]])), top(int(rank[both[parts[x]]]))
                above[max(a, b)] = min(a, b)
    return ids[order[[top(int(r)) for r in rank]]] if len(ids) else ids, n_links


def _verify_groups(words: int, threshold: float):
    """Reads rows sorted by (component, i, j) and verifies each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        current = None

        def done() -> pa.RecordBatch:
            t = pa.concat_tables(held)
            ids = t["rep"].to_numpy()
            i, j = t["i"][0].as_py(), t["j"][0].as_py()
            sides = (t["block"].to_numpy() != i).astype(np.int64) if i != j else np.zeros(len(ids), np.int64)
            root, n = verified(ids, sides, t["copies"].to_numpy(), texts_of(t["text"]), words, threshold)
            return pa.RecordBatch.from_pydict({"rep": ids, "root": root, "n_links": n.astype(np.int64), "parts": t["parts"].combine_chunks() if t["parts"].num_chunks > 1 else t["parts"].chunk(0)})

        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = np.stack([table[c].to_numpy() for c in ("component", "i", "j")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if a == b:
                    continue
                key = tuple(keys[a].tolist())
                if held and key != current:
                    yield done()
                    held.clear()
                current = key
                held.append(table.slice(a, b - a))
        if held:
            yield done()

    return run


def _ties(marked: DataFrame, classes: int) -> DataFrame:
    """Ties (a, b) of each row of marked (rep, bands) to the least of each of its buckets."""
    banded = marked.select("rep", F.posexplode("bands").alias("band", "hash"))
    buckets = banded.groupBy("band", "hash").agg(F.min("rep").alias("least"), F.count("*").alias("n")).filter(F.col("n") > 1)
    bands = F.size("bands")
    total = classes * (marked.agg(F.max(bands)).collect()[0][0] or 1)
    return join_hot(banded, buckets, ["band", "hash"], "rep", total).filter(F.col("least").isNotNull()).select(F.col("rep").alias("a"), F.col("least").alias("b"))


def _sized(components: DataFrame, classes: DataFrame, block: int, block_bytes: int) -> DataFrame:
    """doc_id, component, copies, parts (number of the component's blocks) and block of each node; a written table."""
    nodes = components.join(classes.select(F.col("rep").alias("node"), "copies", "grams"), "node")
    parts = F.ceil(F.greatest(F.count("*") / block, F.sum("grams") * 8 / block_bytes)).cast("int")
    sizes = nodes.groupBy("component").agg(parts.alias("parts"), F.count("*").alias("n"))
    placed = join_hot(nodes, sizes, ["component"], "node", components.count())
    return written(placed.select(F.col("node").alias("doc_id"), "component", "copies", "parts", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("block")), "members")


def near_duplicates(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, rows: int = ROWS, recall: float = RECALL, block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, class_id (least doc_id of its group) and n_links (other documents at the threshold or above)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = docs.filter(F.col("doc_id").isNotNull())
    if known.groupBy("doc_id").count().filter("count > 1").isEmpty():
        found = _unique_near_duplicates(known, words, threshold, rows, recall, block, block_bytes)
    else:
        numbered = _numbered(known)
        own = _unique_near_duplicates(numbered.select(F.col("row_no").alias("doc_id"), "text"), words, threshold, rows, recall, block, block_bytes)
        groups = own.groupBy("class_id").agg(F.count("*").alias("n")).join(numbered.select(F.col("row_no").alias("class_id"), F.col("doc_id").alias("least_doc")), "class_id")
        named = join_hot(own, groups, ["class_id"], "doc_id", numbered.count()).select(F.col("doc_id").alias("row_no"), "least_doc", "n_links")
        found = numbered.select("row_no", "doc_id").join(named, "row_no").select("doc_id", F.col("least_doc").alias("class_id"), "n_links")
    unknown = docs.filter(F.col("doc_id").isNull()).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return found.unionByName(unknown)


def _numbered(rows: DataFrame) -> DataFrame:
    """rows (doc_id, text and others) with row_no, which grows with doc_id, then a hash of the text, then text; a written table."""
    ordered = rows.withColumn("by_text", F.xxhash64("text")).repartitionByRange("doc_id", "by_text").sortWithinPartitions("doc_id", "by_text", "text")
    return written(ordered.drop("by_text").withColumn("row_no", F.monotonically_increasing_id()), "numbered")


def _unique_near_duplicates(known: DataFrame, words: int, threshold: float, rows: int, recall: float, block: int, block_bytes: int) -> DataFrame:
    """The same for rows whose doc_ids are unique."""
    marked = signatures(known, words, rows, bands_for(threshold, rows, recall))
    classes = written(marked.filter(F.col("key").isNotNull()).groupBy("key", "bands", "grams").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes")
    members = _sized(connected_components(_ties(classes, classes.count())), classes, block, block_bytes)

    large = members.filter(F.col("parts") > 1).select("doc_id")
    if not large.isEmpty():
        fine = signatures(known.join(large, "doc_id"), words, FINE_ROWS, bands_for(threshold, FINE_ROWS, recall)).withColumnRenamed("doc_id", "rep")
        parted = _sized(connected_components(_ties(fine, fine.count())), classes, block, block_bytes)
        members = members.filter(F.col("parts") == 1).unionByName(parted)

    texts = known.join(members, "doc_id")
    # a class goes to the pair of its own block with each block
    meeting = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), F.col("doc_id").alias("rep"), "block", "copies", "parts", "text")
    checked = written(meeting.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "rep").mapInArrow(_verify_groups(words, threshold), "rep long, root long, n_links long, parts int"), "verified")

    links = checked.groupBy("rep").agg(F.sum("n_links").alias("n_links"), F.min("root").alias("root"), F.max("parts").alias("parts"))
    across = checked.filter(F.col("parts") > 1).select(F.col("rep").alias("a"), F.col("root").alias("b"))
    if not across.isEmpty():
        wide = connected_components(across)
        links = links.join(wide.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("component", "root"))
    grouped = classes.select("key", "rep", "copies").join(links.select("rep", "root", "n_links"), "rep", "left")
    by_key = grouped.select("key", F.coalesce("root", "rep").alias("class_id"), (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("copies").alias("n"))
    found = join_hot(marked.select("doc_id", "key"), by_key, ["key"], "doc_id", marked.count())
    return found.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """docs without all but the row of least doc_id, then least hash of its text, of each group; rows without a doc_id all stay."""
    rows = as_rows(docs).withColumn("doc_id", F.col("own_row.doc_id").cast("long"))
    known = rows.filter(F.col("doc_id").isNotNull())
    if known.groupBy("doc_id").count().filter("count > 1").isEmpty():
        numbered = known.withColumn("row_no", F.col("doc_id"))
    else:
        numbered = _numbered(known)
    groups = near_duplicates(numbered.select(F.col("row_no").alias("doc_id"), "text"), **settings)
    kept = groups.filter(F.col("doc_id") == F.col("class_id")).select(F.col("doc_id").alias("row_no"))
    return numbered.join(kept, "row_no", "left_semi").select("own_row.*").unionByName(rows.filter(F.col("doc_id").isNull()).select("own_row.*"))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
