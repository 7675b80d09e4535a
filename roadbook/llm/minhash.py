"""Near duplicates by MinHash bands and sequential Bayesian verification.

Each distinct shingle set gets a signature of ``HASHES`` least hash values. Sets that agree on all rows of a band are
candidates. Their signatures are compared batch by batch: after each, a pair goes whose posterior probability of
reaching the similarity (uniform prior, given the values that agree so far) is below ``MISS``. What survives is
verified exactly on the whole sets.

A bucket of many sets is no group of pairs. First every set is held against the bucket's first one, which joins
near copies to one component. Only buckets that still hold several components are compared further: they are cut
into blocks of bounded size, and pairs of blocks are tasks that verify what survives on the spot. A pair is tried in
the first band that its sets share, and only while it would connect something, so a task gives a forest of links.

On request, pairs are also taken from SimHash fingerprints of the sets (:mod:`roadbook.llm.simhash`), found by deletion
variants of their segments. They are verified on the whole sets like all others, and what they connect is not compared
again in the buckets; the bands find the copies whose fingerprints differ in more bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, partial
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from xxhash import xxh3_128_digest, xxh64_intdigest

from roadbook.llm import simhash
from roadbook.llm.components import components
from roadbook.llm.frames import append_columns, blocks, drop, id_key, stay, text_mark, written

#: Seed of a shingle's hash.
SEED = 42
#: Bands and rows of each. Two sets share no band with a probability of 3e-7 at similarity 0.85, of 6e-5 at 0.8.
BANDS, ROWS = 32, 6
HASHES = BANDS * ROWS
#: Signature values compared at once, and the posterior probability of a link below which a pair is dropped.
BATCH, MISS = 32, 1e-6
#: Sets of a bucket, and shingles of all of them, that are compared with each other at once.
BLOCK, BLOCK_SHINGLES = 512, 1 << 19
#: Signature values computed at once per text, so that they stay in the processor's cache.
CHUNK = 256

_R = np.random.default_rng(SEED)
_FACTORS = _R.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _R.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_BAND_SEEDS = _R.integers(0, 1 << 63, BANDS, dtype=np.uint64)

_SKETCH = T.StructType([
    T.StructField("same", T.BinaryType(), True), T.StructField("n", T.LongType(), False),
    T.StructField("signature", T.BinaryType(), True),
])
_PRINT = T.StructField("fingerprint", T.LongType(), False)
_SET = T.StructType([T.StructField("shingles", T.BinaryType(), False)])


def least_matches(compared: int, t: float) -> int:
    """Fewest agreeing values of ``compared`` at which a similarity of ``t`` is still likelier than ``MISS``.

    With a uniform prior, the similarity given m agreements in c is Beta(m + 1, c - m + 1); its weight above t is
    the probability of at most m successes in c + 1 trials of probability t.
    """
    trials, below = compared + 1, 0.0
    for m in range(compared + 1):
        below += comb(trials, m) * t**m * (1 - t) ** (trials - m)
        if below >= MISS:
            return m
    return compared


@dataclass(frozen=True)
class Rule:
    """When two texts are near copies: words in a shingle, and the least similarity of their sets in hundredths."""

    shingle: int = 5
    percent: int = 80

    def shingles(self, text: str | None) -> np.ndarray:
        """Hashes of the distinct shingles, sorted; a text of fewer words is one shingle, one without words none."""
        words = text.encode().lower().split() if text else []
        if len(words) < self.shingle:
            return np.array([xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)
        runs = map(b" ".join, zip(*[words[i:] for i in range(self.shingle)], strict=False))
        return np.unique(np.fromiter(map(partial(xxh64_intdigest, seed=SEED), runs), np.uint64, len(words) - self.shingle + 1))

    def alike(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= self.percent * (len(a) + len(b) - both)

    @cached_property
    def needed(self) -> list[tuple[int, int]]:
        """For each batch, the values compared by its end and how many of them have to agree."""
        return [(end, least_matches(end, self.percent / 100)) for end in range(BATCH, HASHES + 1, BATCH)]

    def likely(self, left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs, of row ``a`` of ``left`` and row ``b`` of ``right``, survive all batches, and how many values agree."""
        alive, agreed = np.arange(len(a)), np.zeros(len(a), np.int32)
        for end, least in self.needed:
            part = slice(end - BATCH, end)
            agreed = agreed + (left[a[alive], part] == right[b[alive], part]).sum(axis=1, dtype=np.int32)
            keep = agreed >= least
            alive, agreed = alive[keep], agreed[keep]
        return alive, agreed


def signature(shingles: np.ndarray) -> np.ndarray:
    """The 16 leading bits of the least value of each hash function over a set that is not empty."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for begin in range(0, len(shingles), CHUNK):
        part = shingles[begin : begin + CHUNK, None] * _FACTORS
        part += _TERMS
        np.minimum(least, part.min(axis=0), out=least)
    # the leading bits of a least value are mostly zero, those below tell values apart
    mixed = least * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(48)).astype(np.uint16)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One key per signature (rows) and band: a hash of the band's values, with the band's number as its last bits."""
    bands = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(_BAND_SEEDS, bands.shape[:2]).copy()
    for row in range(ROWS):
        keys = (keys ^ bands[:, :, row]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return (keys // np.uint64(BANDS) * np.uint64(BANDS) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def sketches(docs: DataFrame, rule: Rule, fingerprints: bool = False) -> DataFrame:
    """Rows with ``same`` (a 128-bit digest of the shingle set, null if it is empty), its size ``n`` and ``signature``.

    With ``fingerprints`` also the set's ``fingerprint``.
    """

    def compute(texts: list[str | None]) -> list[pa.Array]:
        sets = [rule.shingles(text) for text in texts]
        return [
            pa.array([xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
            *([pa.array(simhash.majority_bits(sets), pa.int64())] if fingerprints else []),
        ]

    schema = T.StructType([*_SKETCH, _PRINT]) if fingerprints else _SKETCH
    return append_columns(docs, "text", schema, compute, keep_source=False)


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, HASHES)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, end in blocks(batch.column(1)):
            part = batch.slice(begin, end - begin)
            keys = band_keys(_signatures(part.column(1)))
            nodes = np.repeat(part.column(0).to_numpy(zero_copy_only=False), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(nodes)], names=["key", "node"])


def buckets(nodes: DataFrame) -> DataFrame:
    """``key``, ``node`` and ``first``, the bucket's least node, of all buckets of two sets or more."""
    keys = nodes.select("node", "signature").mapInArrow(_keys, "key long, node long")
    # counted ahead of the shuffle, so a bucket that holds a third of all sets is a few rows there
    shared = keys.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    return keys.join(shared.where("first < last").select("key", "first"), "key")


def _likely_pairs(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``a``, ``b`` that survive the comparison of their signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in blocks(batch.column(2)):
                part = batch.slice(begin, end - begin)
                at = np.arange(len(part))
                kept, _ = rule.likely(_signatures(part.column(2)), _signatures(part.column(3)), at, at)
                yield part.select(["a", "b"]).take(pa.array(kept))

    held = nodes.select("node", "signature")
    both = pairs.join(held.withColumnsRenamed({"node": "a", "signature": "x"}), "a").join(
        held.withColumnsRenamed({"node": "b", "signature": "y"}), "b"
    )
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _sets(named: DataFrame, nodes: DataFrame, docs: DataFrame, rule: Rule, label: str) -> DataFrame:
    """``node`` and ``shingles`` of the nodes named; the whole text of each set's first document is read again."""
    wanted = nodes.join(named, "node").select("node", id_key(F.col("id")).alias("__id"), "mark")
    texts = docs.select(id_key(F.col("id")).alias("__id"), text_mark(F.col("text")).alias("mark"), "text").join(
        wanted, ["__id", "mark"]
    )

    def compute(values: list[str | None]) -> list[pa.Array]:
        return [pa.array([rule.shingles(v).tobytes() for v in values], pa.binary())]

    once = texts.groupBy("node").agg(F.first("text").alias("text"))
    return written(append_columns(once, "text", _SET, compute, keep_source=False), label)[0]


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """Links ``a``, ``b`` among surviving pairs."""
    tried, _ = written(pairs.distinct(), "tried")
    sets = _sets(tried.select(F.col("a").alias("node")).union(tried.select("b")).distinct(), nodes, docs, rule, "tried-sets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in blocks(batch.column(2)):
                part = batch.slice(begin, end - begin)
                sides = zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)
                keep = [rule.alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in sides]
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = tried.join(sets.withColumnsRenamed({"node": "a", "shingles": "x"}), "a").join(
        sets.withColumnsRenamed({"node": "b", "shingles": "y"}), "b"
    )
    return written(both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "first-links")[0]


def _mixed(shared: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of the buckets that hold sets of several components, with ``root``, and the bucket's number of ``parts``.

    In a bucket of two sets both have been compared already.
    """
    rooted, path = written(
        shared.join(known, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root")), "rooted"
    )
    several = rooted.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles")
    )
    parts = F.expr(f"greatest((sets + {BLOCK - 1}) div {BLOCK}, (shingles + {BLOCK_SHINGLES - 1}) div {BLOCK_SHINGLES})")
    found, _ = written(
        rooted.join(several.where("low < high AND sets > 2").select("key", parts.alias("parts")), "key"), "mixed"
    )
    drop(shared.sparkSession, path)
    return found


def _block(sets: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    return (
        np.array([s["node"] for s in sets], np.int64), np.array([s["root"] for s in sets], np.int64),
        np.frombuffer(b"".join(s["signature"] for s in sets), np.uint16).reshape(-1, HASHES), [s["shingles"] for s in sets],
    )


def forest(rule: Rule, band: int, sets: list[dict], others: list[dict] | None) -> list[tuple[int, int]]:
    """Links between two blocks of a bucket, or within one, that connect all components with a link between them.

    Pairs that agree most come first; a pair whose components are connected by then is not verified.
    """
    node_a, root_a, sig_a, held_a = _block(sets)
    node_b, root_b, sig_b, held_b = _block(sets if others is None else others)
    apart = root_a[:, None] != root_b[None, :]
    a, b = np.nonzero(apart if others is not None else apart & (node_a[:, None] < node_b[None, :]))
    kept, agreed = [], []
    for begin in range(0, len(a), 1 << 15):
        one, two = a[begin : begin + (1 << 15)], b[begin : begin + (1 << 15)]
        alive, count = rule.likely(sig_a, sig_b, one, two)
        shared = (sig_a[one[alive]] == sig_b[two[alive]]).reshape(len(alive), BANDS, ROWS).all(axis=2)
        here = shared.argmax(axis=1) == band
        kept.append(alive[here] + begin)
        agreed.append(count[here])
    if not kept:
        return []
    order = np.concatenate(kept)[np.argsort(-np.concatenate(agreed), kind="stable")]
    parent: dict[int, int] = {}

    def top(root: int) -> int:
        while root in parent:
            root = parent[root]
        return root

    links = []
    for i, j in zip(a[order].tolist(), b[order].tolist(), strict=True):
        x, y = top(int(root_a[i])), top(int(root_b[j]))
        if x != y and rule.alike(np.frombuffer(held_a[i], np.uint64), np.frombuffer(held_b[j], np.uint64)):
            parent[max(x, y)] = min(x, y)
            links.append((int(node_a[i]), int(node_b[j])))
    return links


def _cross_links(mixed: DataFrame, nodes: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """Links that connect components which share a bucket."""

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                links = forest(rule, row["key"] % BANDS, row["held"], row["other"])
                a, b = zip(*links, strict=True) if links else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    sets = _sets(mixed.select("node").distinct(), nodes, docs, rule, "mixed-sets")
    full = sets.join(nodes.select("node", "signature"), "node")
    held, _ = written(
        mixed.withColumn("part", F.pmod(F.xxhash64("node", "key"), F.col("parts"))).join(full, "node")
        .groupBy("key", "part", "parts").agg(F.collect_list(F.struct("node", "root", "signature", "shingles")).alias("held")),
        "blocks",
    )
    alone = held.select("key", "held", F.lit(None).cast(held.schema["held"].dataType).alias("other"))
    spread = held.where("part < parts - 1").select("key", "held", F.explode(F.expr("sequence(part + 1, parts - 1)")).alias("at"))
    others = held.where("part > 0").select("key", F.col("part").alias("at"), F.col("held").alias("other"))
    paired = spread.join(others, ["key", "at"]).select("key", "held", "other")
    return written(alone.unionByName(paired).mapInArrow(across, "a long, b long"), "cross-links")[0]


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rule: Rule = Rule(), fingerprints: bool = False,
) -> DataFrame:
    """One row per document: ``id``, ``n_shingles``, ``component_id``, ``kept``, ``root`` and ``mark``.

    Two documents are linked when the sets of their word shingles have the Jaccard similarity that ``rule`` asks for;
    words are split and lowered as ASCII. ``component_id`` is the smallest id in the connected component, and the row
    of that id is ``kept``. Texts without words (null too) are linked with nothing. Documents with equal sets are one
    node, so copies cost nothing. Null ids never name a component unless all of its ids are null; repeated rows are all
    given. ``root`` names the component even where ids are null or stand for several texts (null for texts without
    words), ``mark`` is that of the raw text. Columns other than these two do not matter. With ``fingerprints`` pairs are
    taken from SimHash fingerprints as well.
    """
    named = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    rows, _ = written(sketches(named.withColumn("mark", text_mark(F.col("text"))), rule, fingerprints), "sketches")
    distinct = rows.where("same IS NOT NULL").groupBy("same").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("best"),
        F.first("signature").alias("signature"), F.first("n").alias("n"),
        *([F.first("fingerprint").alias("fingerprint")] if fingerprints else []),
    )
    nodes, _ = written(
        distinct.select(F.monotonically_increasing_id().alias("node"), "best.id", "best.mark", *distinct.drop("best").columns),
        "nodes",
    )
    shared, shared_path = written(buckets(nodes), "buckets")
    starts = shared.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    likely = _likely_pairs(starts, nodes, rule)
    if fingerprints:
        likely = likely.unionByName(simhash.near_pairs(nodes.select("node", "fingerprint")))
    first = _verified(likely, nodes, named, rule)
    mixed = _mixed(shared.join(nodes.select("node", "n"), "node"), components(first))
    drop(docs.sparkSession, shared_path)
    found = components(first.unionByName(_cross_links(mixed, nodes, named, rule)))
    labelled = nodes.join(found, "node", "left").select("same", "id", F.coalesce("root", "node").alias("root"))
    least = labelled.groupBy("root").agg(F.min("id").alias("component_id"))
    names = labelled.join(least, "root").select("same", "component_id", "root")
    component = F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return rows.select("id", "same", "n", "mark").join(names, "same", "left").select(
        "id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"), "root", "mark",
    )


def drop_near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rule: Rule = Rule(), fingerprints: bool = False,
) -> DataFrame:
    """The rows that stay, with all their columns: of each component the one with the smallest id, then mark.

    Null ids come last, so a component without ids keeps one row too. Every text without words stays.
    """
    found = near_duplicates(docs, id_column, text_column, rule, fingerprints)
    best = found.where("root IS NOT NULL").groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("best")
    ).select("best.id", "best.mark")
    return stay(docs, best.unionByName(found.where("root IS NULL").select("id", "mark")), id_column, text_column)
