"""Near duplicates by SimHash fingerprints and deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits. Of two fingerprints that differ in at most three
bits, one segment differs in at most one. So each fingerprint is indexed under both whole segments and under
each segment with one bit as a wildcard; equal keys give candidates, which are verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from xxhash import xxh64_intdigest

from roadbook.llm.components import components
from roadbook.llm.frames import append_columns, stay, text_mark, written

#: Words in a shingle, seed of its hash, and bits in which linked fingerprints may differ.
SHINGLE, SEED, MAX_DIFFER = 3, 42, 3
#: Bits of a segment; one key for the segment itself and one per wildcard bit.
SEGMENT = 32
#: Fingerprints compared with each other at once. Larger groups under one key are compared block by block.
BLOCK = 2048
#: Hashes whose bits are counted in byte lanes before they are widened.
LANE_ROWS = 255

#: For each byte, its bits spread over the eight bytes of an integer.
_SPREAD = np.packbits(
    np.kron(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little"), [1] + [0] * 7).astype(np.uint8),
    axis=1, bitorder="little",
).view(np.uint64).ravel()

_MARKED = T.StructType([T.StructField("fingerprint", T.LongType(), False)])


def shingle_hashes(text: str | None) -> np.ndarray:
    """XXH64 of each shingle, repeats included. ``bytes.lower`` and ``bytes.split`` know ASCII only, as wanted."""
    words = text.encode().lower().split() if text else []
    if len(words) < SHINGLE:
        return np.array([xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)
    runs = map(b" ".join, zip(*[words[i:] for i in range(SHINGLE)], strict=False))
    return np.fromiter(map(partial(xxh64_intdigest, seed=SEED), runs), np.uint64, len(words) - SHINGLE + 1)


def fingerprints(texts: list[str | None]) -> np.ndarray:
    """The fingerprint of each text as a signed integer."""
    return majority_bits([shingle_hashes(text) for text in texts])


def majority_bits(hashes: list[np.ndarray]) -> np.ndarray:
    """The fingerprint of each list of hashes as a signed integer: a bit is set if it is in over half of them."""
    sizes = np.array([len(h) for h in hashes], np.int64)
    flat = np.concatenate([np.zeros(0, np.uint64), *hashes])
    if not len(flat):
        return np.zeros(len(hashes), np.int64)
    starts = np.cumsum(sizes) - sizes
    filled = np.flatnonzero(sizes)
    chunks = -(-sizes[filled] // LANE_ROWS)
    first = np.cumsum(chunks) - chunks
    begin = np.repeat(starts[filled], chunks) + LANE_ROWS * (np.arange(chunks.sum()) - np.repeat(first, chunks))
    lanes = np.add.reduceat(_SPREAD[flat.view(np.uint8)].reshape(-1, 8), begin, axis=0)
    counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 64), first, axis=0, dtype=np.int64)
    bits = 2 * counts > sizes[filled, None]
    out = np.zeros(len(hashes), np.int64)
    out[filled] = np.packbits(bits, axis=1, bitorder="little").view(np.int64).ravel()
    return out


def with_fingerprints(docs: DataFrame, text_column: str = "text", keep_text: bool = True) -> DataFrame:
    """Rows with ``fingerprint``; a text without words (null too) has zero."""

    def compute(texts: list[str | None]) -> list[pa.Array]:
        return [pa.array(fingerprints(texts), pa.int64())]

    return append_columns(docs, text_column, _MARKED, compute, keep_source=keep_text)


def variant_keys(values: np.ndarray) -> np.ndarray:
    """Keys of each fingerprint, one row each: kind << 32 | segment, wildcard bit cleared.

    Kinds 0 to 31 and 33 to 64 have that bit of the low or high segment as wildcard, 32 and 65 none.
    """
    bits = values.view(np.uint64)
    clear = ~np.concatenate([np.uint64(1) << np.arange(SEGMENT, dtype=np.uint64), np.zeros(1, np.uint64)])
    keys = []
    for side in range(2):
        segment = bits >> np.uint64(SEGMENT) if side else bits & np.uint64(0xFFFFFFFF)
        kind = (np.arange(SEGMENT + 1, dtype=np.uint64) + np.uint64(side * (SEGMENT + 1))) << np.uint64(32)
        keys.append(kind[None, :] | (segment[:, None] & clear[None, :]))
    return np.concatenate(keys, axis=1).view(np.int64)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False)
        for begin in range(0, len(values), 4096):
            part = values[begin : begin + 4096]
            keys = variant_keys(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(part, keys.shape[1]))], names=["key", "fingerprint"]
            )


def _wild_bit(key: int) -> int | None:
    """The wildcard bit of a key's kind, as a bit of the whole fingerprint."""
    side, bit = divmod(key >> 32, SEGMENT + 1)
    return None if bit == SEGMENT else side * SEGMENT + bit


def _forest(values: np.ndarray, other: np.ndarray | None, wild: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is linked among ``values`` (and ``other``): a tree per component, not all pairs.

    Under a key with a wildcard only pairs that differ in that bit count; the rest meet under the whole segment.
    """
    every = values if other is None else np.concatenate([values, other])
    if len(every) < 2:
        return every[:0], every[:0]
    bits = every.view(np.uint64)
    if wild is not None:
        one = (bits >> np.uint64(wild)) & np.uint64(1) == 1
        if one.all() or not one.any():
            return every[:0], every[:0]
    label = np.arange(len(every))
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= MAX_DIFFER
    while True:
        least = np.where(near, label[None, :], len(every)).min(axis=1).astype(np.int64)
        least = np.minimum(least, label)[np.minimum(least, label)]
        if (least == label).all():
            break
        label = least
    far = np.flatnonzero(label != np.arange(len(every)))
    return every[far], every[label[far]]


_FOUND = T.StructType([
    T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
    T.StructField("key", T.LongType()), T.StructField("block", T.IntegerType()), T.StructField("held", T.BinaryType()),
])
_FOUND_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("block", pa.int32()), ("held", pa.binary())])


def _link_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
        schema=_FOUND_ARROW,
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by key: links under each key, or, beyond one block, the blocks to be paired later."""
    key_held, held, blocks = None, np.zeros(0, np.int64), 0
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        values = batch.column(1).to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        if key_held is not None and keys[0] != key_held:
            yield from _close(key_held, held, blocks)
            key_held, held, blocks = None, held[:0], 0
        start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[start, len(keys)])
        inner = np.ones(len(start), bool)
        inner[-1] = False  # the last run may go on in the next batch
        inner[0] &= key_held is None
        two = start[inner & (size == 2)]
        x, y = values[two], values[two + 1]
        close = np.bitwise_count((x ^ y).view(np.uint64)) <= MAX_DIFFER
        a, b = [x[close]], [y[close]]
        for i in np.flatnonzero(inner & (size > 2)):
            run = values[start[i] : start[i] + size[i]]
            if len(run) > BLOCK:
                yield from _close(keys[start[i]], run, 0)
            else:
                more = _forest(run, None, _wild_bit(int(keys[start[i]])))
                a.append(more[0])
                b.append(more[1])
        yield _link_batch(np.concatenate(a), np.concatenate(b))
        if key_held is not None and len(start) > 1:  # the run carried over ends in this batch
            yield from _close(key_held, np.concatenate([held, values[: size[0]]]), blocks)
            key_held, held, blocks = int(keys[start[-1]]), values[start[-1] :], 0
        else:
            held = np.concatenate([held, values[start[-1] :]]) if key_held is not None else values[start[-1] :]
            key_held, blocks = int(keys[start[-1]]), blocks if key_held is not None else 0
        while len(held) > BLOCK:
            yield _block(key_held, blocks, held[:BLOCK])
            held, blocks = held[BLOCK:], blocks + 1
    if key_held is not None:
        yield from _close(key_held, held, blocks)


def _block(key: int, number: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([key], pa.int64()), pa.array([number], pa.int32()),
         pa.array([values.tobytes()], pa.binary())], schema=_FOUND_ARROW,
    )


def _close(key: int, values: np.ndarray, blocks: int) -> Iterator[pa.RecordBatch]:
    """The end of a run: links if it fits a block, else its last blocks."""
    if not blocks and len(values) <= BLOCK:
        yield _link_batch(*_forest(values, None, _wild_bit(int(key))))
        return
    for begin in range(0, len(values), BLOCK):
        yield _block(int(key), blocks, values[begin : begin + BLOCK])
        blocks += 1


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            left = np.frombuffer(row["held"], np.int64)
            right = None if row["block"] == row["other_block"] else np.frombuffer(row["other"], np.int64)
            yield _link_batch(*_forest(left, right, _wild_bit(row["key"]))).select(["a", "b"])


def links(distinct: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints differing in at most three bits.

    Every two linked fingerprints end up in one component; within a group under one key only a tree is
    given. Groups beyond a block are cut into blocks, and all pairs of a group's blocks are compared as
    tasks of their own, so a hot key is spread over the cluster.
    """
    keys = distinct.select("fingerprint").mapInArrow(_keys, "key long, fingerprint long")
    sorted_ = keys.repartition("key").sortWithinPartitions("key")
    found, _ = written(sorted_.mapInArrow(_runs, _FOUND), "near-links")
    blocks = found.where("key is not null").select("key", "block", "held")
    last = blocks.groupBy("key").agg(F.max("block").alias("last"))
    spread = blocks.join(last, "key").select(
        "*", F.explode(F.sequence(F.col("block"), F.col("last"))).alias("other_block")
    )
    others = blocks.select("key", F.col("block").alias("other_block"), F.col("held").alias("other"))
    pairs = spread.join(others, ["key", "other_block"]).select("key", "block", "other_block", "held", "other")
    spread_links = pairs.mapInArrow(_paired, "a long, b long")
    return found.where("a is not null").select("a", "b").unionByName(spread_links)


def near_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` (the lesser node first) of nodes whose fingerprints are equal or linked, as a forest.

    ``nodes`` has ``node`` and ``fingerprint``. Nodes of one fingerprint are paired with its least node, and the least
    nodes of linked fingerprints with each other.
    """
    distinct, _ = written(nodes.groupBy("fingerprint").agg(F.min("node").alias("first")), "distinct")
    equal = nodes.join(distinct, "fingerprint").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    ends = links(distinct).join(distinct.withColumnsRenamed({"fingerprint": "a", "first": "x"}), "a").join(
        distinct.withColumnsRenamed({"fingerprint": "b", "first": "y"}), "b"
    )
    return equal.unionByName(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``id``, ``fingerprint`` (long), ``component_id``, ``mark`` of the raw text.

    Two documents are linked when their fingerprints differ in at most three bits; ``component_id`` is the
    smallest id in the connected component. Texts without words have fingerprint zero and are linked like
    any other. Null ids never name a component unless all of its ids are null. Copies share a fingerprint
    and are folded before the search, so groups of copies cost nothing there. Repeated rows are all given.
    """
    named = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    marked = with_fingerprints(named.withColumn("mark", text_mark(F.col("text"))), "text", keep_text=False)
    rows, _ = written(marked, "fingerprints")
    distinct, _ = written(rows.groupBy("fingerprint").agg(F.min("id").alias("first_id")), "distinct")
    found = components(links(distinct))
    nodes = distinct.join(found, distinct["fingerprint"] == found["node"], "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")
    )
    named_roots = nodes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = nodes.join(named_roots, "root").select("fingerprint", "component_id")
    return rows.join(labels, "fingerprint").select("id", "fingerprint", "component_id", "mark")


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: of each component the one with the smallest id.

    Of several texts under that id the one with the smallest mark stays; where all ids are null, likewise.
    """
    found = near_duplicates(docs, id_column, text_column)
    best = found.where(F.col("id").eqNullSafe(F.col("component_id")))
    # a component without ids is told apart by its fingerprints alone, so each of these stays
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fingerprint "), F.col("fingerprint")))
    kept = best.groupBy(group.alias("g")).agg(F.first("id").alias("id"), F.min("mark").alias("mark"))
    return stay(docs, kept.select("id", "mark"), id_column, text_column)
