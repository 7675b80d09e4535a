"""The pipeline's stages against brute force, and its place in the registry."""

import hashlib
import re

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import differences, duck
from roadbook.llm import decontaminate, langid, queries


def _shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def test_rows_are_those_of_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.fit(docs)
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if not model.predict([r.text])[2][0])
    seen, unique = set(), []
    for i, text in rows:
        plain = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        if plain not in seen:
            seen.add(plain)
            unique.append((i, text))
    sets, parent = [_shingles(t) for _, t in unique], list(range(len(unique)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(unique)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 5 * both >= 4 * len(sets[a] | sets[b]) and root(a) != root(b):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    near = [row for k, row in enumerate(unique) if root(k) == k]
    items = [decontaminate.plain(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = [(i, t) for i, t in near if not any(item in decontaminate.plain(t) for item in items)]
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(found) == {i for i, _ in clean}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in clean:
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(found[i].token_ids) == ids and found[i].n_tokens == len(ids)
        assert found[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_stages_keep_the_columns(spark, make_docs, no_docs, tmp_path):
    text = "the onou and ersh ntedly esha and this is of the and"
    docs = make_docs([(1, text), (2, text), (2, text), (3, None), (4, "12 34"), (None, text + " more"), (5, "x y z " * 9000)])
    for frame in (docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, "/root/testdata/sf0.001")
            assert frame.columns == docs.columns, name
        frame.write.parquet(str(tmp_path / str(id(frame))))


def test_registry(spark, sf_dir):
    names = [n for n in entry.queries() if re.match(r"op\d+_|pipeline$", n)]
    assert sorted(int(re.findall(r"\d+", n)[0]) for n in names if n != "pipeline") == list(range(1, 14)) and "pipeline" in names
    found = queries.queries()["op4_exact_dedup"](spark, sf_dir).toArrow()
    assert differences(found, duck(sf_dir).sql(entry.oracle_sql()["op4_exact_dedup"]).to_arrow_table()) == []
