"""Token counts under a sentencepiece BPE model.

A batch of distinct pre-tokens is held as one flat array of symbols with the place where each begins. In
every round each pre-token merges its best pair, all pre-tokens at once, until no pair is left that the
model knows; what survives is counted.

A long pre-token is first cut where no piece holds both characters side by side, as no merge reaches over
such a place. A part that is still long would take a round over all of it for most of its merges; it goes
through a heap of pairs instead, in the same order.
"""

from __future__ import annotations

from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, types as T

from roadbook.llm.frames import append_columns

#: Fixed value: what stands for a space in the pieces of such models.
SPACE = "▁"
#: Bytes of pre-tokens remembered by a worker (about), characters of the longest remembered, characters merged
#: at once, and of a pre-token that is cut and of a part that is merged by itself; only speed depends on them.
KNOWN_BYTES, KNOWN_CHARS, BATCH_CHARS, LONG = 96 << 20, 64, 1 << 20, 96
#: What an entry takes besides its characters, of up to four bytes each.
ENTRY_BYTES, CHAR_BYTES = 150, 4
NONE = np.iinfo(np.int32).max


class Pieces:
    """The pieces of a model as pair merges with ranks."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        usable = [
            i for i in range(size)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        # equal scores share a rank: among them the leftmost pair merges first
        scores = np.array([model.get_score(i) for i in usable], np.float64)
        ranks = np.unique(-scores, return_inverse=True)[1]
        number = {model.id_to_piece(i): n for n, i in enumerate(usable)}
        if any(SPACE in piece.lstrip(SPACE) for piece in number):
            raise ValueError(f"{path} has pieces that reach over a space")
        if not any(model.is_byte(i) for i in range(size)):
            raise ValueError(f"{path} has no pieces for bytes")
        self.size = len(usable)
        code = np.arange(0x110000)
        self.symbol = -(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)).astype(np.int32)
        for piece, n in number.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = n
        pairs = {}
        for piece, n in number.items():
            for cut in range(1, len(piece)):
                a, b = number.get(piece[:cut]), number.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = n
        self.pairs = pairs
        self.beside = np.array(sorted({ord(a) << 21 | ord(b) for piece in number for a, b in zip(piece, piece[1:])}), np.int64)
        keys = np.array(sorted(pairs), np.int64)
        self.keys, self.made = keys, np.array([pairs[k] for k in keys], np.int32)
        self.rank = ranks.astype(np.int32)
        # a rank is settled if no merge of one of its pieces can come before it: all of its pairs may then merge at once
        self.settled = np.ones(int(ranks.max(initial=0)) + 1, bool)
        self.settled[np.flatnonzero(np.bincount(ranks) > 1)] = False
        for side in (keys // self.size, keys % self.size):
            early = self.rank[self.made] <= self.rank[side]
            self.settled[self.rank[side[early]]] = False
        sample = model.encode(f"{SPACE}a  b")  # the dummy prefix and white space are as the counts assume
        if "".join(model.id_to_piece(i) for i in sample) != SPACE * 2 + "a" + SPACE * 2 + "b":
            raise ValueError(f"{path} normalises white space")

    def pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair of symbols; negative symbols are characters that no piece has."""
        if not len(self.keys):
            return np.full(len(a), NONE, np.int32), np.zeros(len(a), np.int32)
        key = np.where((a < 0) | (b < 0), -1, a.astype(np.int64) * self.size + b)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        made = self.made[at]
        return np.where(self.keys[at] == key, self.rank[made], NONE).astype(np.int32), made

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One symbol per character, -n for a character of n UTF-8 bytes that no piece has; and word lengths."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        return self.symbol[codes], np.fromiter(map(len, words), np.int64, len(words))

    def parts(self, word: str) -> list[str]:
        """A pre-token cut between characters that no piece has side by side."""
        codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
        both = codes[:-1] << 21 | codes[1:]
        cut = np.flatnonzero(~np.isin(both, self.beside, kind="sort")) + 1
        ends = [*cut.tolist(), len(word)]
        return [word[a:b] for a, b in zip([0, *ends], ends)]

    def count(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token (none of them empty)."""
        if max(map(len, words), default=0) <= LONG:
            return self._rounds(words)
        cut = [self.parts(w) if len(w) > LONG else [w] for w in words]
        owner = np.repeat(np.arange(len(words)), list(map(len, cut)))
        parts = [part for pieces in cut for part in pieces]
        tokens = np.zeros(len(parts), np.int64)
        short = [k for k, part in enumerate(parts) if len(part) <= LONG]
        if short:
            tokens[short] = self._rounds([parts[k] for k in short])
        for k, part in enumerate(parts):
            if len(part) > LONG:
                tokens[k] = self._heap(part)
        return np.bincount(owner, tokens, len(words)).astype(np.int64)

    def _heap(self, part: str) -> int:
        """Tokens of one long part: the pair of best rank merges first, of equal ones the leftmost."""
        symbol, _ = self.symbols([part])
        n, size, pairs, ranks = len(symbol), self.size, self.pairs, self.rank.tolist()
        rank, _ = self.pair(symbol[:-1], symbol[1:])
        at = np.flatnonzero(rank != NONE)
        heap = (rank[at].astype(np.int64) * n + at).tolist()
        heapify(heap)
        row, after, before = symbol.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        left = sum(max(1, -s) for s in row)
        gone = -1  # like a character that no piece has, it merges with nothing
        while heap:
            best, i = divmod(heappop(heap), n)
            j = after[i]
            if row[i] < 0 or j == n or row[j] < 0:
                continue
            made = pairs.get(row[i] * size + row[j])
            if made is None or ranks[made] != best:
                continue
            row[i], row[j] = made, gone
            left -= 1
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                if row[j] >= 0 and (new := pairs.get(made * size + row[j])) is not None:
                    heappush(heap, ranks[new] * n + i)
            j = before[i]
            if j >= 0 and row[j] >= 0 and (new := pairs.get(row[j] * size + made)) is not None:
                heappush(heap, ranks[new] * n + j)
        return left

    def _rounds(self, words: list[str]) -> np.ndarray:
        """The same, merging all pre-tokens in step."""
        symbol, length = self.symbols(words)
        total = np.zeros(len(words), np.int64)
        word = np.repeat(np.arange(len(words)), length)
        rank, made = self._pairs(symbol, word)
        while len(symbol):
            begin = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(rank, begin)
            over = best == NONE
            if over.any():  # these words are done: count and drop them
                sizes = np.diff(np.r_[begin, len(word)])
                done = np.repeat(over, sizes)
                total += np.bincount(word[done], np.where(symbol[done] < 0, -symbol[done], 1), len(total)).astype(np.int64)
                symbol, word, rank, made = symbol[~done], word[~done], rank[~done], made[~done]
                best, sizes = best[~over], sizes[~over]
                if not len(symbol):
                    break
            else:
                sizes = np.diff(np.r_[begin, len(word)])
            at = np.flatnonzero(rank == np.repeat(best, sizes))
            symbol, word, rank, made = self._merge(symbol, word, rank, made, self._chosen(at, word, rank))
        return total

    def _pairs(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, made = np.full(len(symbol), NONE, np.int32), np.zeros(len(symbol), np.int32)
        if len(symbol) > 1:
            same = np.flatnonzero(word[1:] == word[:-1])
            rank[same], made[same] = self.pair(symbol[same], symbol[same + 1])
        return rank, made

    def _chosen(self, at: np.ndarray, word: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Of the places with a word's best rank: the first, or, where the rank is settled, all that do not overlap."""
        first = np.r_[True, word[at[1:]] != word[at[:-1]]]
        # in a run of neighbouring places every second one overlaps the one before
        starts = np.r_[True, (at[1:] != at[:-1] + 1) | first[1:]]
        run = np.flatnonzero(starts)
        order = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
        return at[first | (self.settled[rank[at]] & (order % 2 == 0))]

    def _merge(self, symbol, word, rank, made, at):
        symbol[at] = made[at]
        keep = np.ones(len(symbol), bool)
        keep[at + 1] = False
        place = np.cumsum(keep) - 1
        symbol, word, rank, made = symbol[keep], word[keep], rank[keep], made[keep]
        new = place[at]
        touched = np.zeros(len(symbol), bool)
        touched[new] = touched[np.maximum(new - 1, 0)] = True
        changed = np.flatnonzero(touched)
        rank[changed], inner = NONE, changed[changed + 1 < len(symbol)]
        inner = inner[word[inner] == word[inner + 1]]
        rank[inner], made[inner] = self.pair(symbol[inner], symbol[inner + 1])
        return symbol, word, rank, made


class Counter:
    """Counts tokens of whole texts; keeps the counts of pre-tokens it has met."""

    def __init__(self, path: str):
        self.pieces, self.known, self.held = Pieces(path), {}, 0

    @staticmethod
    def pre_tokens(text: str) -> list[str]:
        """What follows each space mark, up to the next one. Marks in a row belong to one pre-token.

        The mark before each pre-token is left out. Merges never reach over it, as no piece does.
        """
        parts = text.replace(" ", SPACE).split(SPACE)
        if "" not in parts:
            return parts
        out, marks = [], ""
        for part in parts:
            if part:
                out.append(marks + part)
                marks = ""
            else:
                marks += SPACE
        if marks:
            out.append(marks[:-1])
        return out

    def count(self, texts: list[str | None]) -> list[int]:
        if self.held > KNOWN_BYTES:
            self.known.clear()
            self.held = 0
        cut = [self.pre_tokens(text) if text else [] for text in texts]
        known = self.known
        new = [w for w in set().union(*cut) if w not in known]
        new.sort(key=len)  # words of like length finish in like rounds
        begin, size = 0, 0
        for end, w in enumerate(new, 1):
            size += len(w) + 1
            if size >= BATCH_CHARS or end == len(new):
                part = new[begin:end]
                known.update(zip(part, self.pieces.count([SPACE + w for w in part]).tolist(), strict=True))
                begin, size = end, 0
        counts = [sum(map(known.__getitem__, words)) for words in cut]
        for w in reversed(new):
            if len(w) <= KNOWN_CHARS:
                break
            del known[w]
        kept = [len(w) for w in new if len(w) <= KNOWN_CHARS]
        self.held += ENTRY_BYTES * len(kept) + CHAR_BYTES * sum(kept)
        return counts


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One counter per worker and model."""
    return Counter(path)


COUNTED = T.StructType(
    [T.StructField("n_bytes", T.LongType(), False), T.StructField("n_tokens", T.LongType(), False)]
)


def count_tokens(docs: DataFrame, path: str, text_column: str = "text") -> DataFrame:
    """Rows with ``n_bytes`` (UTF-8) and ``n_tokens`` of the whole text under the model file at ``path``.

    No begin, end or other token is added; special strings inside a text are plain text. A null or empty
    text has none of either. Repeated rows are counted each; input columns of these names are replaced.
    """

    def compute(texts: list[str | None]) -> list[pa.Array]:
        sizes = [len(t.encode()) if t else 0 for t in texts]
        return [pa.array(sizes, pa.int64()), pa.array(counter(path).count(texts), pa.int64())]

    return append_columns(docs, text_column, COUNTED, compute)
