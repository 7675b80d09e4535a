"""Language by the nearest centroid of TF-IDF vectors of character n-grams.

N-grams of one to three letters are hashed to a fixed number of places. Each language has several centroids,
found by clustering a bounded sample of its texts on the unit sphere. A text gets the language of the centroid
with the largest cosine; one too far from it is rejected.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from roadbook.llm.frames import append_columns, blocks, filter_rows, held_out

#: Places for hashed n-grams, longest n-gram, centroids per language.
PLACES, LONGEST, CENTROIDS = 16384, 3, 4
#: Texts per language that centroids are fitted on, at most, and groups of tasks in which these are first chosen.
SAMPLE, SLOTS = 400, 16
#: A text is rejected below this share of the similarity that all but ``LOW_TAIL`` of a language's sample reach, cut to
#: texts that fill as many places; the numbers of places are told apart by powers of two.
REJECT_SHARE, LOW_TAIL, SPANS = 0.5, 0.02, 15
#: Lengths the sample is cut to, besides whole texts, and texts counted at once.
CUTS, AT_ONCE = (8, 16, 32, 64, 128, 256, 512), 256
#: What a model may weigh, as it is sent to every worker.
MODEL_BYTES = 256 << 20
UNKNOWN = "und"
ROUNDS = 12
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed n-grams per text, and whether the text has a letter.

    Texts are in lower case; each stretch without letters is one blank, as are begin and end of a text.
    """
    lower = [text.lower() if text else "" for text in texts]
    sizes = np.fromiter(map(len, lower), np.int64, len(lower)) + 2
    codes = np.frombuffer((" " + "  ".join(lower) + " ").encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(lower)), sizes)
    letter = _letters()[codes]
    found = np.zeros(len(lower), bool)
    found[row[letter]] = True
    keep = letter | np.r_[True, letter[:-1]] | np.r_[True, row[1:] != row[:-1]]
    symbol, row = np.where(letter, codes, 32)[keep].astype(np.uint32), row[keep]
    out = np.zeros(len(lower) * PLACES, np.float32)
    mixed = np.zeros(len(symbol), np.uint32)
    for n in range(LONGEST):
        # symbol i and the n before it, all of one text
        mixed = symbol * _MIX[n] ^ np.r_[np.zeros(1, np.uint32), mixed[:-1]] * np.uint32(31)
        whole = symbol != 32 if not n else np.r_[np.zeros(n, bool), row[n:] == row[:-n]][: len(row)]
        place = (mixed ^ (mixed >> np.uint32(15))) % np.uint32(PLACES)
        out += np.bincount(row[whole] * PLACES + place[whole], minlength=len(out)).astype(np.float32)
    return out.reshape(len(lower), PLACES), found


@dataclass
class Model:
    """Languages in order, and their centroids; bounded by the number of languages."""

    idf: np.ndarray
    languages: list[str]
    of: np.ndarray  # language of each centroid
    centroids: np.ndarray
    floor: np.ndarray  # similarity under which a language rejects, by span of filled places

    def vectors(self, table: np.ndarray) -> np.ndarray:
        return weigh(table, self.idf)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, similarity to its nearest centroid, and whether the text is rejected."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        names, scores, rejected = [], [np.zeros(0)], [np.zeros(0, bool)]
        for begin in range(0, len(texts), AT_ONCE):
            table, found = counts(texts[begin : begin + AT_ONCE])
            likeness = self.vectors(table) @ self.centroids.T
            best = likeness.argmax(axis=1)
            score = np.clip(likeness[np.arange(len(table)), best].astype(np.float64), 0, 1) * found
            language = self.of[best]
            names += [self.languages[k] if f else UNKNOWN for k, f in zip(language, found, strict=True)]
            scores.append(score)
            rejected.append(~found | (score < self.floor[language, spans(table)]))
        return names, np.concatenate(scores), np.concatenate(rejected)


def spans(table: np.ndarray) -> np.ndarray:
    """The power of two at or below the number of filled places."""
    filled = (table > 0).sum(axis=1)
    return np.minimum(np.log2(np.maximum(filled, 1)).astype(int), SPANS - 1)


def floors(texts: list[str], idf: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The least similarity accepted, by span, from texts and their beginnings.

    A span that hardly any of them has takes the floor of the next shorter one.
    """
    likeness, span = [np.zeros(0)], [np.zeros(0, int)]
    for cut in (*CUTS, None):
        parts = [t[:cut] for t in texts if cut is None or len(t) > cut]
        for begin in range(0, len(parts), AT_ONCE):
            table, found = counts(parts[begin : begin + AT_ONCE])
            likeness.append((weigh(table[found], idf) @ centers.T).max(axis=1) if found.any() else np.zeros(0))
            span.append(spans(table[found]))
    likeness, span = np.concatenate(likeness), np.concatenate(span)
    out, last = np.zeros(SPANS), 0.0
    for k in range(SPANS):
        own = likeness[span == k]
        if len(own) >= 1 / LOW_TAIL or (len(own) and not last):
            last = REJECT_SHARE * float(np.quantile(own, LOW_TAIL))
        out[k] = last
    return out


def weigh(table: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF vectors of length one; a text without n-grams has none."""
    vectors = np.log1p(table) * idf
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norm > 0, norm, 1)


def cluster(vectors: np.ndarray, k: int) -> np.ndarray:
    """Centroids of vectors on the unit sphere. Starts from the vectors farthest from those chosen before."""
    mean = vectors.mean(axis=0)
    chosen = [vectors[int((vectors @ mean).argmax())]]
    for _ in range(1, min(k, len(vectors))):
        nearest = (vectors @ np.array(chosen).T).max(axis=1)
        chosen.append(vectors[int(nearest.argmin())])
    centroids = np.array(chosen)
    for _ in range(ROUNDS):
        own = (vectors @ centroids.T).argmax(axis=1)
        sums = np.array([vectors[own == j].sum(axis=0) if (own == j).any() else centroids[j] for j in range(len(centroids))])
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = sums / np.where(norm > 0, norm, 1)
    return centroids


def _document_counts(rows: DataFrame) -> tuple[np.ndarray, dict[str, int]]:
    """In how many texts each place occurs, and texts per language; a task sends fixed-size sums."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, languages = np.zeros(PLACES, np.int64), {}
        for batch in batches:
            for begin, end in blocks(batch.column(1)):
                part = batch.slice(begin, end - begin)
                for name in part.column(0).to_pylist():
                    languages[name] = languages.get(name, 0) + 1
                texts = part.column(1).to_pylist()
                for first in range(0, len(texts), AT_ONCE):
                    present += (counts(texts[first : first + AT_ONCE])[0] > 0).sum(axis=0)
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array([None] * PLACES + [*languages], pa.string()),
             "place": pa.array([*range(PLACES)] + [None] * len(languages), pa.int32()),
             "n": pa.array([*present.tolist(), *languages.values()], pa.int64())}
        )

    found = rows.select("lang", "text").mapInArrow(sums, "lang string, place int, n long").groupBy("lang", "place").agg(F.sum("n"))
    present, languages = np.zeros(PLACES, np.int64), {}
    for name, place, n in found.collect():  # places and languages, whatever the input
        if place is None:
            languages[name] = n
        else:
            present[place] = n
    return present, languages


def _sample(rows: DataFrame) -> DataFrame:
    """Of each language the ``SAMPLE`` distinct texts with the least hashes, or all if there are fewer.

    Only hashes are ranked, first in ``SLOTS`` groups of tasks, so that a language's last task gets as many from each
    group at most, however many tasks there are; a task then gives each chosen text once.
    """
    hashed = rows.select("lang", "text", F.xxhash64("text").alias("hash"))
    least = hashed.select("lang", "hash").distinct().withColumn("slot", F.spark_partition_id() % SLOTS)
    for keys in (("lang", "slot"), ("lang",)):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("hash"))
        least = least.withColumn("rank", rank).where(F.col("rank") <= SAMPLE).drop("rank")
    last = {r["lang"]: r["last"] for r in least.groupBy("lang").agg(F.max("hash").alias("last")).collect()}
    limit = F.create_map(*[F.lit(x) for pair in last.items() for x in pair])

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True))
            new = [key not in seen and not seen.add(key) for key in keys]
            yield batch.filter(pa.array(new, pa.bool_()))

    cut = hashed.where(F.col("hash") <= limit[F.col("lang")]).mapInArrow(once, "lang string, text string, hash long")
    return cut.dropDuplicates(["lang", "hash"])


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> Model:
    """A model from rows that have a text and a language and whose id's crc32 is not divisible by five.

    Document counts cover all of these rows; centroids come from ``SAMPLE`` distinct texts per language, or all it has.
    """
    rows = docs.where(~held_out(id_column)).select(
        F.col(f"`{lang_column}`").cast("string").alias("lang"), F.col(f"`{text_column}`").cast("string").alias("text")
    ).where("lang is not null and text is not null")
    present, languages = _document_counts(rows)
    total = sum(languages.values())
    idf = np.log((1 + total) / (1 + present)).astype(np.float32) + np.float32(1)
    if len(languages) * CENTROIDS * PLACES * 4 > MODEL_BYTES:
        raise ValueError(f"centroids of {len(languages)} languages exceed {MODEL_BYTES} bytes")
    if not languages:
        return Model(idf, [], np.zeros(0, int), np.zeros((0, PLACES), np.float32), np.zeros((0, SPANS)))

    def centroids(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("hash")
        table, found = counts(part["text"].tolist())
        vectors = weigh(table, idf)[found]
        if not len(vectors):
            return pd.DataFrame({"lang": [], "part": [], "vector": [], "floor": []})
        centers = cluster(vectors, CENTROIDS).astype(np.float32)
        floor = floors(part["text"].tolist(), idf, centers).tolist()
        return pd.DataFrame(
            {"lang": key[0], "part": range(len(centers)), "vector": [c.tobytes() for c in centers], "floor": [floor] * len(centers)}
        )

    found = _sample(rows).groupBy("lang").applyInPandas(centroids, "lang string, part int, vector binary, floor array<double>")
    got = sorted(found.collect(), key=lambda r: (r["lang"], r["part"]))
    names = sorted({r["lang"] for r in got})
    floor = {r["lang"]: r["floor"] for r in got}
    return Model(
        idf, names, np.array([names.index(r["lang"]) for r in got], int),
        np.array([np.frombuffer(r["vector"], np.float32) for r in got], np.float32).reshape(-1, PLACES),
        np.array([floor[name] for name in names]).reshape(-1, SPANS),
    )


_PREDICTED = T.StructType([
    T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False),
    T.StructField("rejected", T.BooleanType(), False),
])


def identify(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """Rows with ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``, from the whole text alone.

    A text that is null or has no letter is ``und`` with score 0 and rejected; so is every text under a model
    without languages. Equal similarities go to the language that comes first. Repeated rows are each given.
    """

    def compute(texts: list[str | None]) -> list[pa.Array]:
        names, score, rejected = model.predict(texts)
        return [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]

    return append_columns(docs, text_column, _PREDICTED, compute)


def drop_rejected(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows whose language is not rejected, with all their columns."""
    return filter_rows(docs, text_column, lambda texts: (~model.predict(texts)[2]).tolist())
