"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

Cosines of random projections approximate a Gaussian kernel over standardised statistics of a text. Each task
sums its share of the normal equations; the sums of two folds give one model per fold and one of both. The
fold models score the other fold's rows, and isotonic regression over these scores gives the calibration.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from roadbook.llm.frames import append_columns, held_out, id_key, id_text, written

#: Random features, width of the kernel in standard deviations per statistic, ridge weight per row, and seed.
FEATURES, WIDTH, RIDGE, SEED = 256, 1.5, 1e-3, 7
#: Bins of raw scores for the calibration and the range they cover; scores beyond it fall in the outer bins.
BINS, LOW, HIGH = 512, -0.5, 1.5
#: Score at which a text is predicted to be of quality.
THRESHOLD = 0.3

STATISTICS = [
    "log_chars", "log_words", "mean_word", "word_spread", "letters", "upper", "digits", "symbols", "bars", "marks",
    "same_as_before", "distinct_words", "top_word", "distinct_triples", "log_lines", "distinct_lines",
    "short_words", "capital_words", "all_capital_words", "odd_endings",
]
_SYMBOL, _MARK, _LETTER = re.compile(r"[^\w\s.,;:'\"()\-]"), re.compile(r"[.,;:]"), re.compile(r"[^\W\d_]")
_UPPER, _DIGIT = re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"\d")


def statistics(text: str | None) -> list[float]:
    """The statistics of one text, in the order of :data:`STATISTICS`; a null text is empty."""
    text = text or ""
    words, lines = text.split(), text.splitlines()
    n, w = max(1, len(text)), max(1, len(words))
    lengths = np.fromiter(map(len, words), np.float64, len(words))
    seen: dict[str, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    triples = len(set(zip(words, words[1:], words[2:], strict=False)))
    ascii_ = text.isascii()
    letters = len(_LETTER.findall(text))
    return [
        np.log1p(len(text)), np.log1p(len(words)), float(lengths.mean()) if len(words) else 0.0,
        float(lengths.std()) if len(words) else 0.0, letters / n,
        (sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")) if ascii_ else len(_UPPER.findall(text))) / n,
        sum(map(text.count, "0123456789")) / n, len(_SYMBOL.findall(text)) / n, text.count("|") / w,
        sum(map(text.count, ".,;:")) / w,
        sum(a == b for a, b in pairwise(words)) / w, len(seen) / w, max(seen.values(), default=0) / w,
        triples / max(1, len(words) - 2), np.log1p(len(lines)), len(set(lines)) / max(1, len(lines)),
        float((lengths <= 3).mean()) if len(words) else 0.0, sum(x[0].isupper() for x in words) / w,
        sum(len(x) > 1 and x.isupper() for x in words) / w,
        sum(not (x[-1].isalnum() or x[-1] in ".,;:") for x in words) / w,
    ]


_STATED = T.StructType([T.StructField("stats", T.ArrayType(T.DoubleType(), False), False)])


def with_statistics(docs: DataFrame, text_column: str = "text", keep_text: bool = True) -> DataFrame:
    """Rows with ``stats``, the statistics of the whole text."""

    def compute(texts: list[str | None]) -> list[pa.Array]:
        values = np.array([statistics(text) for text in texts], np.float64).reshape(-1, len(STATISTICS))
        ends = np.arange(len(texts) + 1, dtype=np.int32) * len(STATISTICS)
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))]

    return append_columns(docs, text_column, _STATED, compute, keep_source=keep_text)


@dataclass
class Model:
    """A fitted scorer; all of it is of fixed size."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the model over both folds
    by_fold: np.ndarray  # of the models that have not seen fold 0 and fold 1
    points: np.ndarray  # raw scores and
    values: np.ndarray  # their calibrated ones

    def features(self, stats: np.ndarray) -> np.ndarray:
        random = np.random.default_rng(SEED)
        directions = random.normal(0, 1 / (WIDTH * np.sqrt(len(STATISTICS))), (len(STATISTICS), FEATURES))
        shifts = random.uniform(0, 2 * np.pi, FEATURES)
        plain = np.clip((stats - self.mean) / self.scale, -8, 8)
        return np.hstack([np.ones((len(stats), 1)), plain, np.sqrt(2 / FEATURES) * np.cos(plain @ directions + shifts)])

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.features(stats) @ self.weights, self.points, self.values)


SIZE = 1 + len(STATISTICS) + FEATURES


def _stack(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("stats")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def _moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each statistic."""
    sums = [f(F.col("stats")[i]).alias(f"{name}{i}") for i in range(len(STATISTICS)) for name, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = np.array([x if x is not None else 0.0 for x in rows.agg(*sums).first()], np.float64)
    scale = row[1::2]
    return row[0::2], np.where(scale > 1e-9, scale, 1.0)


def _normal_sums(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z zᵀ and z y by fold. A task sends one matrix per fold, which is of fixed size."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SIZE, SIZE + 1))
        for batch in batches:
            stats, label = _stack(batch), batch.column("label").to_numpy(zero_copy_only=False)
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            for begin in range(0, len(stats), 4096):
                part = slice(begin, begin + 4096)
                z, y, f = model.features(stats[part]), label[part], fold[part]
                for k in range(2):
                    own = f == k
                    total[k] += z[own].T @ np.column_stack([z[own], y[own]])
        yield pa.RecordBatch.from_pydict(
            {"place": pa.array(range(2 * SIZE), pa.int32()), "row": pa.array([r.tobytes() for r in total.reshape(2 * SIZE, -1)], pa.binary())}
        )

    def add(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(SIZE + 1)
        for row in part["row"]:
            total += np.frombuffer(row)
        return pd.DataFrame({"place": [key[0]], "row": [total.tobytes()]})

    schema = "place int, row binary"
    found = rows.select("stats", "label", "fold").mapInArrow(sums, schema).groupBy("place").applyInPandas(add, schema)
    total = np.zeros((2 * SIZE, SIZE + 1))
    for place, row in found.collect():  # 2 * SIZE rows, whatever the input
        total[place] = np.frombuffer(row)
    total = total.reshape(2, SIZE, SIZE + 1)
    return total[:, :, :SIZE], total[:, :, SIZE]


def _ridge(matrix: np.ndarray, target: np.ndarray) -> np.ndarray:
    weight = RIDGE * max(1.0, matrix[0, 0])
    penalty = np.full(SIZE, weight)
    penalty[0] = 1e-6
    return np.linalg.solve(matrix + np.diag(penalty), target)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Least-squares non-decreasing fit: neighbours that decrease are pooled."""
    level: list[list[float]] = []
    for value, weight in zip(values, weights, strict=True):
        level.append([value, weight, 1])
        while len(level) > 1 and level[-2][0] >= level[-1][0]:
            v, w, n = level.pop()
            u, x, m = level.pop()
            level.append([(u * x + v * w) / (x + w), x + w, m + n])
    return np.concatenate([np.full(n, v) for v, _, n in level]) if level else np.zeros(0)


def _calibrate(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Points of the calibration from scores by models that have not seen the row."""

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            raw = (model.features(_stack(batch)) * model.by_fold[fold]).sum(axis=1)
            place = np.clip(((raw - LOW) / (HIGH - LOW) * BINS).astype(np.int64), 0, BINS - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(place.astype(np.int32)), batch.column("label"), pa.array(raw)], names=["place", "label", "raw"]
            )

    bins = rows.select("stats", "label", "fold").mapInArrow(binned, "place int, label double, raw double")
    sums = bins.groupBy("place").agg(F.count(F.lit(1)), F.avg("label"), F.avg("raw")).orderBy("place").collect()
    if not sums:
        return np.array([0.0]), np.array([0.5])
    count, label, raw = (np.array([r[i] for r in sums], np.float64) for i in (1, 2, 3))
    return raw, np.clip(isotonic(label, count), 0, 1)


def learnable(stated: DataFrame, labels: DataFrame, id_column: str, label_column: str) -> DataFrame:
    """Statistics and labels of the rows that may be learned from. Several labels of an id are averaged."""
    known = labels.where(F.col(f"`{label_column}`").isNotNull()).groupBy(id_key(F.col(f"`{id_column}`")).alias("__id")).agg(
        F.avg(F.col(f"`{label_column}`").cast("double")).alias("label")
    )
    fold = (F.floor(F.crc32(id_text(id_column).cast("binary")) / 5) % 2).cast("int")
    rows = stated.where(~held_out(id_column)).select(id_key(F.col(f"`{id_column}`")).alias("__id"), "stats", fold.alias("fold"))
    return rows.join(known, "__id").select("stats", "fold", "label")


def fit(rows: DataFrame) -> Model:
    """A model of ``stats``, ``fold`` and ``label``. Without rows every score is one half."""
    mean, scale = _moments(rows)
    none = np.zeros(SIZE)
    model = Model(mean, scale, none, np.array([none, none]), np.array([0.0]), np.array([0.5]))
    matrices, targets = _normal_sums(rows, model)
    if not matrices[:, 0, 0].sum():
        return model
    model.weights = _ridge(matrices.sum(axis=0), targets.sum(axis=0))
    model.by_fold = np.array([_ridge(matrices[1 - k], targets[1 - k]) for k in range(2)])
    model.points, model.values = _calibrate(rows, model)
    return model


_SCORED = T.StructType([T.StructField("score", T.DoubleType(), False)])


def classify(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality"
) -> DataFrame:
    """``id``, ``held_out``, ``score`` and ``predicted`` of every row, by a model fitted on the labelled ones.

    Rows whose id's crc32 is divisible by five are never learned from; nor are rows without label. A null id
    counts as the empty text, a null text as empty, and repeated rows each get their score. The whole text is
    read once; statistics are written to the shared folder, as three passes use them.
    """
    named = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    stated, _ = written(with_statistics(named, "text", keep_text=False), "statistics")
    marks = labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").alias("label"))
    rows, _ = written(learnable(stated, marks, "id", "label"), "labelled")
    model = fit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(model.score(_stack(batch)))],
                names=["id", "held_out", "score"],
            )

    frame = stated.select("id", held_out("id").alias("held_out"), "stats")
    schema = T.StructType([frame.schema["id"], frame.schema["held_out"], *_SCORED.fields])
    return frame.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
