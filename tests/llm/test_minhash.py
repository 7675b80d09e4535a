"""MinHash near duplicates against brute force over all pairs."""

import random

import numpy as np
import pytest

from roadbook.llm import minhash, queries

RULE = minhash.Rule(3, 85)


def _set(text, shingle=3):
    words = (text or "").encode().lower().split()
    runs = {tuple(words[i : i + shingle]) for i in range(len(words) - shingle + 1)}
    return runs or ({tuple(words)} if words else set())


def _brute(rows, rule=RULE):
    """Sorted (id, size, component, kept), each pair of sets compared."""
    sets = [_set(t, rule.shingle) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= rule.percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted((str(i), len(sets[k]), str(c := least.get(root(k))), i == c) for k, (i, _) in enumerate(rows))


def _found(frame):
    return sorted((str(r.id), r.n_shingles, str(r.component_id), r.kept) for r in frame.collect())


def _near(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"x{rng.random()}"
    return " ".join(words)


def test_query_is_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = queries.op12_minhash(spark, sf_dir).withColumnRenamed("doc_id", "id")
    assert _found(found) == _brute([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(odd_docs):
    docs = odd_docs.selectExpr("*", "'clash' AS node", "1 AS same", "2 AS signature", "3 AS key", "4 AS mark")
    assert _found(minhash.near_duplicates(docs, rule=RULE)) == _brute([(r.doc_id, r.text) for r in odd_docs.collect()])


def test_near_copies_at_the_limit(make_docs):
    """Pairs a little above and below the similarity, chains, copies and unrelated texts."""
    rng, rows = random.Random(5), []
    for g in range(40):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([4, 30, 120, 600]))]
        rows += [(100 * g + k, _near(rng, base, rng.choice([0, 0, 1, 1, 2, 4, 8, 12]))) for k in range(6)]
    rng.shuffle(rows)
    assert _found(minhash.near_duplicates(make_docs(rows), rule=RULE)) == _brute(rows)
    assert _found(minhash.near_duplicates(make_docs(rows))) == _brute(rows, minhash.Rule())


def test_rows_that_stay(make_docs):
    """Of each component the least id, with all columns; texts without words all stay, repeated rows count as one."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(3, text), (2, text + " end"), (2, "other words that stand alone here"), (None, text), (5, None), (6, ""), (6, ""), (None, "q r s t u v")]
    stayed = minhash.drop_near_duplicates(make_docs(rows, "root mark kept"))
    assert sorted((str(r.doc_id), (r.text or "")[:5]) for r in stayed.collect()) == [
        ("2", "other"), ("2", "w0 w1"), ("5", ""), ("6", ""), ("None", "q r s")
    ]
    assert stayed.columns[-3:] == ["root", "mark", "kept"]


def test_crowded_buckets_are_compared_in_blocks(make_docs, monkeypatch):
    """One text in many versions that differ too much from the first, but form groups of near copies."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng, rows = random.Random(9), []
    base = [f"w{i}" for i in range(150)]
    for g in range(25):
        version = _near(rng, base, 8).split()
        rows += [(10 * g + k, _near(rng, version, 1)) for k in range(3)]
    assert _found(minhash.near_duplicates(make_docs(rows), rule=RULE)) == _brute(rows)


def test_large_group_of_copies_and_near_copies(make_docs):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base)) for i in range(300)] + [(1000 + i, _near(rng, base, 1)) for i in range(200)]
    found = minhash.near_duplicates(make_docs(rows), rule=RULE).collect()
    assert {r.component_id for r in found} == {0} and [r.id for r in found if r.kept] == [0]


def test_no_rows(no_docs, make_docs):
    assert minhash.near_duplicates(no_docs, rule=RULE).count() == 0
    assert _found(minhash.near_duplicates(make_docs([(1, None), (2, " "), (1, None)]))) == _brute([(1, None), (2, " "), (1, None)])


def test_signatures_agree_as_sets_do():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for share in (0.5, 0.85, 0.95):
        both = int(2000 * share)
        a, b = pool[:2000], np.concatenate([pool[:both], pool[2000 : 4000 - both]])
        likeness = both / (4000 - both)
        agree = (minhash.signature(a) == minhash.signature(b)).mean()
        assert abs(agree - likeness) < 4 * np.sqrt(likeness * (1 - likeness) / minhash.HASHES)


@pytest.mark.parametrize("compared", [32, 96, 192])
def test_pruning_keeps_to_the_miss_probability(compared):
    """The posterior by numerical integration: the limit is the fewest agreements that are likely enough."""
    s = np.linspace(0, 1, 200_001)[1:-1]
    needed = minhash.least_matches(compared, 0.85)
    for m, enough in ((needed, True), (needed - 1, False)):
        log = m * np.log(s) + (compared - m) * np.log1p(-s)
        weight = np.exp(log - log.max())
        assert (weight[s >= 0.85].sum() / weight.sum() >= minhash.MISS) == enough


def test_pairs_come_from_fingerprints_too(spark, make_docs, monkeypatch):
    rng = random.Random(5)
    words = [f"w{rng.randrange(900)}" for _ in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "end"])), (3, " ".join(words[::-1])), (4, " ".join(words).upper() + " x"), (5, "")]
    docs, rule = make_docs(rows), minhash.Rule()
    wanted = _brute(rows, rule)
    assert _found(minhash.near_duplicates(docs, rule=rule, fingerprints=True)) == wanted == _found(minhash.near_duplicates(docs, rule=rule))
    # without the bands, the fingerprints alone find what differs in three bits
    monkeypatch.setattr(minhash, "buckets", lambda nodes: nodes.selectExpr("n AS key", "node", "node AS first").where("key < 0"))
    assert _found(minhash.near_duplicates(docs, rule=rule, fingerprints=True)) == wanted
    assert sorted(r.doc_id for r in minhash.drop_near_duplicates(docs, rule=rule, fingerprints=True).collect()) == [1, 3, 5]
