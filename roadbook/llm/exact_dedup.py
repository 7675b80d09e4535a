"""Exact duplicates through a minimal perfect hash over the distinct digests of earlier documents.

The index is dealt into shards by digest. In a shard every distinct digest has a slot of its own that holds
the full digest, the winner's id and the group's size. An incoming digest is hashed to a slot and compared
there byte by byte: members join the stored group, the others are grouped among themselves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from roadbook.llm.frames import stay, text_mark, written

#: Digests in a shard of the index, 48 bytes each.
SHARD_DIGESTS = 100_000
#: Places per digest on each level of the hash; more places mean fewer levels and more bits.
SPREAD = 2
#: Stands for a null id, which comes after all others.
LAST_ID = (1 << 63) - 1

INDEX = "shard int, levels array<int>, taken binary, digests binary, winners binary, sizes binary"
VERDICT = "digest binary, member boolean, first_id long, n long, stored_id long, stored_n long"


def digest(text: Column) -> Column:
    """SHA-256 of a text in which each stretch of ASCII white space is one space; null counts as empty."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.unhex(F.sha2(plain, 256))


def document_digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id``, ``digest`` and ``copies``: how often the row is repeated. Ids are integers or null."""
    rows = docs.select(
        F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(LAST_ID)).alias("id"),
        digest(F.col(f"`{text_column}`")).alias("digest"),
        text_mark(F.col(f"`{text_column}`")).alias("mark"),
    )
    return rows.groupBy("id", "digest").agg(F.count(F.lit(1)).alias("copies"), F.min("mark").alias("mark"))


def groups(digests: DataFrame) -> DataFrame:
    """One row per distinct digest; counted before the shuffle, so a hot digest is a few rows."""
    return digests.groupBy("digest").agg(F.min("id").alias("first_id"), F.sum("copies").alias("n"))


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int").alias("shard")


def build_index(stored: DataFrame, shards: int) -> DataFrame:
    """The index over ``groups`` of the history: one row per shard."""

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keys = _words(rows["digest"])
        levels, taken, slot = minimal_hash(keys)
        order = np.argsort(slot)
        return pd.DataFrame(
            {
                "shard": [key[0]], "levels": [levels], "taken": [np.packbits(taken).tobytes()],
                "digests": [keys[order].tobytes()],
                "winners": [rows["first_id"].to_numpy(np.int64)[order].tobytes()],
                "sizes": [rows["n"].to_numpy(np.int64)[order].tobytes()],
            }
        )

    return stored.select("*", _shard(shards)).groupBy("shard").applyInPandas(build, INDEX)


def look_up(index: DataFrame, incoming: DataFrame, shards: int) -> DataFrame:
    """For each of the incoming ``groups``, whether its digest is stored, and the stored winner and size."""

    def probe(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = rows[["digest", "first_id", "n"]].assign(member=False, stored_id=None, stored_n=None)
        if len(found) and len(rows):
            shard, keys = found.iloc[0], _words(rows["digest"])
            held = np.frombuffer(shard["digests"], np.uint64).reshape(-1, 4)
            taken = np.unpackbits(np.frombuffer(shard["taken"], np.uint8)).astype(bool)
            slot = find_slots(keys, np.asarray(shard["levels"]), taken)
            member = (slot >= 0) & (held[np.maximum(slot, 0)] == keys).all(axis=1)
            for name, source in (("stored_id", "winners"), ("stored_n", "sizes")):
                values = pd.array(np.frombuffer(shard[source], np.int64)[np.maximum(slot, 0)], dtype="Int64")
                values[~member] = pd.NA
                out[name] = values
            out["member"] = member
        return out[["digest", "member", "first_id", "n", "stored_id", "stored_n"]]

    probes = incoming.select("*", _shard(shards)).groupBy("shard")
    return probes.cogroup(index.groupBy("shard")).applyInPandas(probe, VERDICT)


def _words(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, digests)), np.uint64).reshape(-1, 4)


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where a level puts each key: its words, mixed with the level's number."""
    with np.errstate(over="ignore"):
        mixed = keys[:, level % 4] + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) ^ keys[:, (level + 1) % 4]
        return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


def minimal_hash(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Sizes of the levels, their places in a row (true: one key's own), and each key's slot.

    Keys that have a place for themselves stay on a level, the others go on to the next. A slot is the
    number of taken places before a key's own, so n keys have the slots 0 to n - 1.
    """
    levels, taken, place, open_, base = [], [], np.zeros(len(keys), np.int64), np.arange(len(keys)), 0
    while len(open_):
        size = SPREAD * len(open_)
        at = _places(keys[open_], len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        settled = alone[at]
        place[open_[settled]] = base + at[settled]
        levels.append(size)
        taken.append(alone)
        base += size
        open_ = open_[~settled]
    flags = np.concatenate(taken) if taken else np.zeros(0, bool)
    return levels, flags, (np.cumsum(flags) - 1)[place] if len(keys) else place


def find_slots(keys: np.ndarray, levels: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """The slot that each key is hashed to; -1 where it meets no taken place. Unknown keys get any slot."""
    rank, slot, open_, base = np.cumsum(taken) - 1, np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, size in enumerate(levels):
        at = base + _places(keys[open_], level, int(size))
        hit = taken[at]
        slot[open_[hit]] = rank[at[hit]]
        open_, base = open_[~hit], base + int(size)
    return slot


def find_duplicates(
    history: DataFrame, incoming: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document of both: ``id``, ``keep_id``, ``group_size``, ``kept``, ``digest``, ``mark``.

    Texts are equal when identical after white space is normalised; a null text is empty. The smallest id
    of a group stays, null ids come last, and of repeated rows one stays. Either input may be empty.
    ``mark`` is the raw text's of one of the rows with that id and digest. Only digests and ids move.
    """
    names = {"id_column": id_column, "text_column": text_column}
    old, _ = written(document_digests(history, **names), "digests-old")
    new, _ = written(document_digests(incoming, **names), "digests-new")
    stored, _ = written(groups(old), "groups-old")
    fresh, _ = written(groups(new), "groups-new")
    shards = max(1, -(-max(stored.count(), fresh.count()) // SHARD_DIGESTS))
    index, _ = written(build_index(stored, shards), "digest-index")
    verdicts, _ = written(look_up(index, fresh, shards), "verdicts")
    joined = verdicts.where("member").select("digest", F.col("first_id").alias("new_id"), F.col("n").alias("new_n"))
    grown = stored.join(joined, "digest", "left").select(
        "digest",
        F.least("first_id", "new_id").alias("keep"),  # least() passes over nulls
        (F.col("n") + F.coalesce("new_n", F.lit(0))).alias("size"),
    )
    alone = verdicts.where("not member").select("digest", F.col("first_id").alias("keep"), F.col("n").alias("size"))
    rows = old.unionByName(new).groupBy("id", "digest").agg(F.sum("copies").alias("copies"), F.min("mark").alias("mark"))
    every = rows.join(grown.unionByName(alone), "digest")
    return every.select(
        _null_last("id").alias("id"),
        _null_last("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
        (F.col("id") == F.col("keep")).alias("first"),
        "digest",
        "mark",
    ).select("id", "keep_id", "group_size", (F.col("first") & (F.col("copy") == 1)).alias("kept"), "digest", "mark")


def _null_last(name: str) -> Column:
    return F.when(F.col(name) != LAST_ID, F.col(name))


def split_at(docs: DataFrame, id_column: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Documents up to the middle of the id range as history, the later ones as incoming."""
    column = F.col(f"`{id_column}`").cast("long")
    low, high = docs.agg(F.min(column), F.max(column)).first()
    middle = ((low or 0) + (high or 0)) // 2
    early = F.coalesce(column <= middle, F.lit(False))
    return docs.where(early), docs.where(~early)


def drop_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    found = find_duplicates(*split_at(docs, id_column), id_column, text_column)
    return stay(docs, found.where("kept").select("id", "mark"), id_column, text_column)
