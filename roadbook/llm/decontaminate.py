"""Benchmark passages inside documents, by the q-gram lemma and banded alignment.

A passage of m characters found with at most k edits shares at least m - q + 1 - kq q-grams with its place,
all within k neighbouring diagonals. Shared q-grams are counted in bands of diagonals of which each overlaps
half of the next, so that any k + 1 neighbouring diagonals lie in one band. Bands that reach the bound are
aligned; what stays within the edit budget is a hit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from roadbook.llm.frames import blocks, filter_rows, written

#: Length of a q-gram, edits allowed per character of a passage, and characters of the shortest that is searched for.
Q, EDIT_SHARE, SHORTEST = 8, 0.1, 8
#: Length of the q-grams of passages too short to share one of the former with each place within their edits.
SHORT_Q = 4
#: Characters of passages that are sent to the workers at once; larger sets are searched block by block.
BLOCK_ITEM_CHARS = 4_000_000
#: Characters of documents searched at once, and pairs of passage and band aligned at once.
PASS_CHARS, ALIGN_PAIRS = 1 << 19, 256
_BASE, _FLAGS = np.uint64(0x9E3779B97F4A7C15), 22


def plain(text: str | None) -> str:
    """Lower case, each stretch of white space one space."""
    return " ".join(text.lower().split()) if text else ""


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q characters from each place on; q is a power of two, so halves are joined."""
    value, width, base = (codes.astype(np.uint64) + np.uint64(1)) * _BASE, 1, _BASE
    with np.errstate(over="ignore"):
        while width < q:
            if len(value) <= width:
                return value[:0]
            value = value[:-width] * base + (value[width:] ^ (value[width:] >> np.uint64(29)))
            base, width = base * _BASE, 2 * width
    return value


@dataclass
class Item:
    item_id: object
    text: str
    codes: np.ndarray
    edits: int


class Grams:
    """The q-grams of passages that share one at least with any place within their edits."""

    def __init__(self, items: list[Item], q: int):
        self.items, self.q = items, q
        grams = [_grams(item.codes, q) for item in self.items]
        every = np.concatenate([np.zeros(0, np.uint64), *grams])
        owner = np.repeat(np.arange(len(grams)), list(map(len, grams))).astype(np.int64)
        place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(g)) for g in grams)])
        order = np.argsort(every, kind="stable")
        self.grams, first = np.unique(every[order], return_index=True)
        self.first = np.r_[first, len(every)]
        self.owner, self.place = owner[order], place[order]
        self.flag = np.zeros(1 << _FLAGS, bool)
        self.flag[self._spot(self.grams)] = True
        self.edits = np.array([i.edits for i in self.items], np.int64)
        self.bound = np.array([len(i.codes) - q + 1 - i.edits * q for i in self.items], np.int64)

    @staticmethod
    def _spot(grams: np.ndarray) -> np.ndarray:
        return (grams >> np.uint64(64 - _FLAGS)).astype(np.int64)

    def bands(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, item and first diagonal of each band whose shared q-grams reach the item's bound."""
        none = np.zeros(0, np.int64)
        if not self.items or not texts:
            return none, none, none
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        start = np.cumsum(sizes) - sizes
        grams = _grams(_codes("\n".join(texts)), self.q)  # plain texts have no line ends, nor have passages
        at = np.flatnonzero(self.flag[self._spot(grams)])
        spot = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
        same = self.grams[spot] == grams[at]
        at, spot = at[same], spot[same]
        count = self.first[spot + 1] - self.first[spot]
        reach = np.cumsum(count)
        source = np.repeat(self.first[spot] - reach + count, count) + np.arange(reach[-1] if len(reach) else 0)
        at = np.repeat(at, count)
        row = np.searchsorted(start, at, "right") - 1
        item = self.owner[source]
        cell = (at - start[row] - self.place[source]) // (self.edits[item] + 1)
        low = int(cell.min(initial=0))
        span = int(cell.max(initial=0)) - low + 3
        key, shared = np.unique((row * len(self.items) + item) * span + (cell - low + 1), return_counts=True)
        # a band is a cell and the next one; it begins at a cell with hits or at the one before
        begin = np.unique(np.concatenate([key, key - 1]))
        total = np.zeros(len(begin), np.int64)
        for shift in (0, 1):
            spot = np.minimum(np.searchsorted(key, begin + shift), max(0, len(key) - 1))
            if len(key):
                total += np.where(key[spot] == begin + shift, shared[spot], 0)
        pair = begin // span
        row, item = pair // len(self.items), pair % len(self.items)
        good = total >= self.bound[item]
        cell = begin[good] % span + low - 1
        return row[good], item[good], cell * (self.edits[item[good]] + 1)


class Passages:
    """A block of passages, to be found in texts."""

    def __init__(self, rows: list[tuple[object, str | None]]):
        self.short: dict[str, list[object]] = {}
        long, small = [], []
        for item_id, text in rows:
            text = plain(text)
            m = len(text)
            if m < SHORTEST:
                if m:
                    self.short.setdefault(text, []).append(item_id)
                continue
            item = Item(item_id, text, _codes(text), int(EDIT_SHARE * m))
            (long if m - Q + 1 > item.edits * Q else small).append(item)
        self.groups = [Grams(items, q) for items, q in ((long, Q), (small, SHORT_Q)) if items]

    def find(self, texts: list[str | None]) -> list[tuple[int, object, int, int, int, int]]:
        """Hits as (text, item id, begin, end, edits, passage length); offsets are into the plain text."""
        flat = [plain(text) for text in texts]
        hits = [(row, i, 0, len(text), 0, len(text)) for row, text in enumerate(flat) for i in self.short.get(text, [])]
        for group in self.groups:
            hits.extend(self._aligned(group, flat))
        return hits

    @staticmethod
    def _aligned(group: Grams, flat: list[str]) -> Iterator[tuple[int, object, int, int, int, int]]:
        """The best place of each passage in each text, of the bands that reach its bound."""
        row, item, diagonal = group.bands(flat)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for begin in range(0, len(row), ALIGN_PAIRS):
            part = slice(begin, begin + ALIGN_PAIRS)
            pairs = [(flat[r], group.items[i], int(d)) for r, i, d in zip(row[part], item[part], diagonal[part], strict=True)]
            for r, i, (edits, start, end) in zip(row[part], item[part], align(pairs), strict=True):
                if edits <= group.items[i].edits:
                    best[r, i] = min(best.get((r, i), (edits, start, end)), (edits, start, end))
        for (r, i), (edits, start, end) in sorted(best.items()):
            yield int(r), group.items[i].item_id, start, end, edits, len(group.items[i].text)


def _banded(patterns: list[np.ndarray], windows: list[np.ndarray], widths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of each pattern against its window, and the diagonal where the best alignment ends.

    Row j, column d holds the edits of j pattern characters against window characters up to d + j; the begin
    is free. All pairs go row by row together; a shorter pattern keeps its last row.
    """
    n, longest, width = len(patterns), max(map(len, patterns)), max(widths)
    pattern = np.zeros((n, longest), np.int64)
    window = np.full((n, longest + width), -1, np.int64)
    for k in range(n):
        pattern[k, : len(patterns[k])] = patterns[k]
        w = windows[k][: longest + width]
        window[k, : len(w)] = w
    length = np.array(list(map(len, patterns)))
    column = np.arange(width)
    far = 1 << 30
    out = column[None, :] >= np.array(widths)[:, None]
    cost = np.where(out, far, 0)
    for j in range(longest):
        swap = cost + (window[:, j : j + width] != pattern[:, j : j + 1])
        skip = np.concatenate([cost[:, 1:] + 1, np.full((n, 1), far)], axis=1)
        step = np.where(out, far, np.minimum(swap, skip))
        step = np.minimum.accumulate(step - column, axis=1) + column
        cost = np.where((j < length)[:, None], np.where(out, far, step), cost)
    return cost.min(axis=1), cost.argmin(axis=1)


def align(pairs: list[tuple[str, Item, int]]) -> list[tuple[int, int, int]]:
    """Edits, begin and end of each passage within its band of diagonals of the text."""
    if not pairs:
        return []
    patterns, windows, widths, begins = [], [], [], []
    for text, item, diagonal in pairs:
        width = 2 * (item.edits + 1)
        low, high = max(0, diagonal), min(len(text), diagonal + width + len(item.codes))
        codes = np.full(high - diagonal, -2, np.int64)  # a band may begin before the text
        codes[low - diagonal :] = _codes(text[low:high])
        patterns.append(item.codes)
        windows.append(codes)
        widths.append(width)
        begins.append(diagonal)
    edits, at = _banded(patterns, windows, widths)
    ends = [min(b + int(a) + len(p), len(text)) for b, a, p, (text, _, _) in zip(begins, at, patterns, pairs, strict=True)]
    # backwards from the end for the begin
    back = []
    for (text, item, _), end in zip(pairs, ends, strict=True):
        reach = max(0, end - len(item.codes) - item.edits - 1)
        back.append(_codes(text[reach:end])[::-1].astype(np.int64))
    _, start = _banded([p[::-1] for p in patterns], back, [i.edits + 1 for _, i, _ in pairs])
    return [
        (int(e), max(0, end - int(s) - len(p)), end) for e, s, p, end in zip(edits, start, patterns, ends, strict=True)
    ]


def item_blocks(items: DataFrame, id_column: str, text_column: str) -> Iterator[list[tuple[object, str | None]]]:
    """The passages in blocks that are safe to send to workers."""
    rows = items.select(F.col(f"`{id_column}`").alias("item_id"), F.col(f"`{text_column}`").alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-2 * total // BLOCK_ITEM_CHARS)) if total > BLOCK_ITEM_CHARS else 1
    for part in range(parts):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        size = own.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0] if parts > 1 else total
        if size > 2 * BLOCK_ITEM_CHARS:
            raise ValueError(f"a block of passages has {size} characters")
        yield [(r["item_id"], r["text"]) for r in own.orderBy("item_id").collect()]


def find_passages(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_id_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """One row per document and passage found in it: ``id``, ``item_id``, ``begin``, ``end``, ``edits``, ``length``.

    A passage is found where at most ``EDIT_SHARE`` of its characters have to be edited, case and white space
    aside. ``begin`` and ``end`` are offsets into the text in lower case with single spaces; of several places
    the one with the fewest edits, then the first, is given. A passage shorter than ``SHORTEST`` counts only
    where it is the whole text; null and empty ones never do. Null texts hold none. Repeated rows and
    repeated passages are each given. Documents are read once per block of passages and never shuffled.
    """
    named = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("id", named.schema["id"].dataType), T.StructField("item_id", items.schema[item_id_column].dataType),
        *(T.StructField(n, T.IntegerType(), False) for n in ("begin", "end", "edits", "length")),
    ])
    found = None
    for rows in item_blocks(items, item_id_column, item_text_column):
        part = _search(named, rows, schema)
        if len(rows) and found is not None:
            part, _ = written(part, "passages")
        found = part if found is None else found.unionByName(part)
    return found


def _search(named: DataFrame, rows: list, schema: T.StructType) -> DataFrame:
    passages = Passages(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for begin, end in blocks(batch.column(1), PASS_CHARS):
                ids = batch.column(0).slice(begin, end - begin)
                hits = passages.find(batch.column(1).slice(begin, end - begin).to_pylist())
                columns = list(zip(*hits, strict=True)) or [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(columns[0], pa.int64())).cast(arrow.field(0).type)]
                    + [pa.array(columns[k], arrow.field(k).type) for k in range(1, 6)],
                    schema=arrow,
                )

    return named.mapInArrow(run, schema)


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text_column: str = "text", item_id_column: str = "item_id", item_text_column: str = "text"
) -> DataFrame:
    """The rows that hold none of the passages, with all their columns."""
    kept = docs
    for rows in item_blocks(items, item_id_column, item_text_column):
        passages = Passages(rows)

        def clean(texts: list[str | None], passages: Passages = passages) -> list[bool]:
            hit = {row for row, *_ in passages.find(texts)}
            return [row not in hit for row in range(len(texts))]

        kept = filter_rows(kept, text_column, clean)
    return kept
