"""Merkle trees against a plain recursion, and queries against their SQL."""

import hashlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import differences, duck
from roadbook.llm import merkle


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _sized(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _tree(nodes, fanout):
    """The root and, for each node, the siblings before and after on each level."""
    paths, level = [[] for _ in nodes], [(d, [i]) for i, d in enumerate(nodes)]
    while len(level) > 1:
        runs = [level[i : i + fanout] for i in range(0, len(level), fanout)]
        for run in runs:
            for k, (_, members) in enumerate(run):
                for m in members:
                    paths[m].append(("".join(d for d, _ in run[:k]), "".join(d for d, _ in run[k + 1 :])))
        level = [(_h(*[d for d, _ in run]), sum([m for _, m in run], [])) for run in runs]
    return level[0][0], paths


def _brute(rows, fanout):
    """Sorted (id, leaf, subroot, root, path) of all rows."""
    groups = {}
    for r in rows:
        leaf = _h(*[_sized(r[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")])
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf, r["doc_id"]))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: _tree([leaf for _, _, leaf, _ in sorted(groups[g], key=lambda t: t[:3])], fanout) for g in order}
    root, above = _tree([trees[g][0] for g in order], fanout)
    return sorted(
        (str(i), leaf, trees[g][0], root, str(trees[g][1][k] + above[at]))
        for at, g in enumerate(order) for k, (_, _, leaf, i) in enumerate(sorted(groups[g], key=lambda t: t[:3]))
    )


def _found(frame):
    return sorted(
        (str(r.id), r.leaf, r.subroot, r.root, str([(s.before, s.after) for s in r.path])) for r in frame.collect()
    )


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_odd_rows(odd_docs, fanout):
    docs = odd_docs.withColumns({
        "lang": F.when(F.col("doc_id") > 3, "de").when(F.col("doc_id") == 3, ""),
        "source": F.when(F.col("doc_id") != 2, F.col("source")),
    }).selectExpr("*", "'clash' AS grp", "1 AS pos", "2 AS id", "3 AS digest", "4 AS n")
    assert _found(merkle.manifest(docs, fanout=fanout)) == _brute([r.asDict() for r in odd_docs.sparkSession.createDataFrame(docs.collect(), docs.schema).collect()], fanout)


@pytest.mark.parametrize("block", [4, 16])
def test_groups_of_all_sizes(make_docs, monkeypatch, block):
    """Groups of 1 to 20 rows and one of 300: runs that are full, short and single on every level."""
    monkeypatch.setattr(merkle, "BLOCK", block)
    rows = [(1000 * g + i, f"text {g} {i}", f"l{g:02d}") for g in range(1, 21) for i in range(g)]
    rows += [(i, f"more {i % 9}", None) for i in range(300)]
    docs = make_docs(rows)
    assert _found(merkle.manifest(docs)) == _brute([r.asDict() for r in docs.collect()], 2)


def test_one_group_owning_most_rows_is_sorted_by_many_tasks(spark, make_docs):
    docs = make_docs([(i, "same", "en" if i % 10 else "de") for i in range(2000)])
    ordered, _ = merkle._numbered(docs.selectExpr("doc_id AS id", "lang AS grp", "text AS digest"), ["id", "digest"])
    places = ordered.groupBy("grp").agg(F.collect_list(F.struct("id", "pos")).alias("all")).collect()
    for r in places:
        ids = [p.id for p in sorted(r["all"], key=lambda p: p.pos)]
        assert ids == sorted(ids) and [p.pos for p in sorted(r["all"], key=lambda p: p.pos)] == list(range(len(ids)))


def test_repeated_rows_are_leaves_of_their_own(make_docs):
    docs = make_docs([(7, "a b")] * 5 + [(None, None)] * 3)
    assert _found(merkle.manifest(docs)) == _brute([r.asDict() for r in docs.collect()], 2)


def test_lone_row(make_docs):
    row = merkle.manifest(make_docs([(1, "x")])).first()
    assert row.leaf == row.subroot == row.root and row.path == []


def test_no_rows(no_docs):
    assert merkle.manifest(no_docs).count() == 0


def test_changes_are_noticed(make_docs):
    docs = make_docs([(i, f"t {i}") for i in range(9)])
    changed = {"n_chars": F.when(F.col("doc_id") == 4, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    found = merkle.manifest(docs, changed=changed).withColumn("folded", merkle.fold(F.col("other_leaf"), F.col("path")))
    assert {r.id for r in found.collect() if r.folded != r.root} == {4}


def test_fanout_of_one_is_refused(make_docs):
    with pytest.raises(ValueError, match="two slots"):
        merkle.manifest(make_docs([(1, "x")]), fanout=1)


def test_query_is_its_sql(spark, sf_dir):
    got = entry.queries()["op13_merkle"](spark, sf_dir).toArrow()
    assert differences(got, duck(sf_dir).sql(entry.oracle_sql()["op13_merkle"]).to_arrow_table()) == []
