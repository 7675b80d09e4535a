"""Exact and near duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from xxhash import xxh64_intdigest

from roadbook.llm import components, exact_dedup, simhash


def _plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def _exact(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(_plain(text), []).append(i)
    first = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted((str(i), str(first[_plain(t)]), len(groups[_plain(t)]), hashlib.sha256(_plain(t).encode()).hexdigest()) for i, t in rows)


def _found(frame):
    return sorted((str(r.id), str(r.keep_id), r.group_size, bytes(r.digest).hex()) for r in frame.collect())


def test_exact_groups(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    found = exact_dedup.find_duplicates(*exact_dedup.split_at(odd_docs))
    assert _found(found) == _exact(rows)
    kept = found.where("kept").collect()
    assert len(kept) == len({_plain(t) for _, t in rows})
    assert all(r.id == r.keep_id for r in kept)


@pytest.mark.parametrize("side", ["history", "incoming"])
def test_one_side_empty(make_docs, no_docs, side):
    docs = make_docs([(3, "x y"), (1, "x  y"), (2, "z")])
    found = exact_dedup.find_duplicates(*((docs, no_docs) if side == "history" else (no_docs, docs)))
    assert _found(found) == _exact([(3, "x y"), (1, "x  y"), (2, "z")])
    assert exact_dedup.find_duplicates(no_docs, no_docs).count() == 0


def test_winner_may_be_incoming(make_docs):
    found = exact_dedup.find_duplicates(make_docs([(9, "a"), (8, "b")]), make_docs([(1, "a"), (7, "c")]))
    assert {(r.id, r.keep_id, r.kept) for r in found.collect()} == {(9, 1, False), (1, 1, True), (8, 8, True), (7, 7, True)}


def test_several_shards(make_docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SHARD_DIGESTS", 7)
    rows = [(i, f"text {i % 37}") for i in range(200)]
    assert _found(exact_dedup.find_duplicates(*exact_dedup.split_at(make_docs(rows)))) == _exact(rows)


def test_whole_rows_stay(make_docs):
    docs = make_docs([(1, "a b"), (1, "a b"), (2, "a  b"), (3, None), (4, ""), (None, "q"), (None, "q")], "digest kept mark keep_id copies id")
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str((r.doc_id, r.text, r.digest)) for r in kept.collect()) == sorted(
        str(x) for x in [(1, "a b", "clash"), (3, None, "clash"), (None, "q", "clash")]
    )


def test_hash_is_minimal_and_perfect():
    keys = np.random.default_rng(0).integers(0, 1 << 63, (5000, 4), np.uint64)
    levels, taken, slot = exact_dedup.minimal_hash(keys)
    assert sorted(slot) == list(range(5000))
    assert (exact_dedup.find_slots(keys, levels, taken) == slot).all()
    others = np.random.default_rng(1).integers(0, 1 << 63, (1000, 4), np.uint64)
    found = exact_dedup.find_slots(others, levels, taken)
    assert ((found >= -1) & (found < 5000)).all()
    assert exact_dedup.minimal_hash(keys[:0])[0] == []


def _fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)]
    hashes = [xxh64_intdigest(run, 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def _components(prints, ids):
    parent = list(range(len(prints)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                parent[root(a)] = root(b)
    least = {}
    for k in range(len(prints)):
        if ids[k] is not None:
            least[root(k)] = min(ids[k], least.get(root(k), ids[k]))
    return [least.get(root(k)) for k in range(len(prints))]


def test_fingerprints(odd_docs):
    texts = [r.text for r in odd_docs.collect() if len(r.text or "") < 1000] + ["w" + " x" * 700]
    assert [int(f) % (1 << 64) for f in simhash.fingerprints(texts)] == [_fingerprint(t) for t in texts]
    assert len(simhash.fingerprints([])) == 0


def test_near_components(make_docs):
    chance = random.Random(3)
    base = [" ".join(chance.choice("abcdefghij") * chance.randint(1, 3) for _ in range(120)) for _ in range(6)]
    rows = [(i, " ".join("zz" if chance.random() < 0.01 else w for w in base[i % 6].split())) for i in range(240)]
    rows += [(300, None), (301, ""), (302, " \n"), (None, base[0]), (5, rows[5][1])]
    found = simhash.near_duplicates(make_docs(rows)).collect()
    wanted = _components([_fingerprint(t) for _, t in rows], [i for i, _ in rows])
    assert sorted(str((r.id, r.fingerprint % (1 << 64), r.component_id)) for r in found) == sorted(
        str((i, _fingerprint(t), c)) for (i, t), c in zip(rows, wanted, strict=True)
    )


@pytest.mark.parametrize("block", [4, 2048])
def test_crowded_keys_lose_no_link(spark, monkeypatch, block):
    """Many fingerprints under one key, compared in one block or in many."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    chance = np.random.default_rng(5)
    values = np.unique(np.concatenate([
        (np.uint64(0xABCDEF0123456789) ^ (np.uint64(1) << chance.integers(0, 64, 60).astype(np.uint64))),
        np.uint64(0xABCDEF01) << np.uint64(32) | chance.integers(0, 1 << 32, 60).astype(np.uint64),
        chance.integers(0, 1 << 63, 40).astype(np.uint64),
    ])).view(np.int64)
    keys = np.sort(np.stack([simhash.variant_keys(values).ravel(), np.repeat(values, 66)], 1).view("i8,i8").ravel(), order="f0")
    for size in (7, 100_000):
        batches = [pa.RecordBatch.from_arrays([pa.array(k["f0"]), pa.array(k["f1"])], names=["key", "fingerprint"])
                   for k in (keys[i : i + size] for i in range(0, len(keys), size))]
        rows = [r for b in simhash._runs(iter(batches)) for r in b.to_pylist()]
        found = {(r["a"], r["b"]) for r in rows if r["a"] is not None}
        held = {}
        for r in rows:
            if r["key"] is not None:
                held.setdefault(r["key"], []).append(np.frombuffer(r["held"], np.int64))
        for key, parts in held.items():
            for i, left in enumerate(parts):
                for right in parts[i:]:
                    a, b = simhash._forest(left, None if right is left else right, simhash._wild_bit(key))
                    found |= set(zip(a.tolist(), b.tolist(), strict=True))
        prints = [int(v) % (1 << 64) for v in values]
        wanted = _components(prints, list(range(len(values))))
        parent = {int(v): int(v) for v in values}

        def root(v, parent=parent):
            while parent[v] != v:
                v = parent[v]
            return v

        for a, b in found:
            assert (a ^ b) % (1 << 64) >= 0
            parent[root(a)] = root(b)
        groups = {}
        for v, c in zip(values.tolist(), wanted, strict=True):
            groups.setdefault(c, set()).add(root(v))
        assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_blocks_are_paired_on_spark(spark, monkeypatch, make_docs):
    values = [(0x1234 << 32) + k for k in range(40)]
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    wanted = _components(values, values)
    links = simhash.links(frame)
    found = {r.node: r.root for r in components.components(links).collect()}
    assert [found.get(v, v) for v in values] == wanted


def test_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 100), (7, 7), (200, 150), (150, 175)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(51)} | {100: 100, 101: 100, 150: 150, 175: 150, 200: 150}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_a_component_stays(make_docs, no_docs):
    text = "one two three four five six seven eight nine ten"
    docs = make_docs([(4, text), (2, text.upper()), (2, text.upper()), (9, "something else entirely here"), (None, text), (None, None)], "fingerprint mark id")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == sorted(
        str(x) for x in [(2, text.upper()), (9, "something else entirely here"), (None, None)]
    )
    assert simhash.near_duplicates(no_docs).count() == simhash.drop_near_duplicates(no_docs).count() == 0
