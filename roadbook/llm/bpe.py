"""Byte-level BPE encoding and decoding.

Distinct words are put into a trie. A node stands for a prefix and holds the last token of that prefix's
encoding, which follows from the nodes above it: of the tokens that end there, exactly one leaves a prefix
whose own last token stays apart from it. Prefixes that words share are so encoded once.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable, Iterable
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from roadbook.llm.frames import append_columns

#: Fixed value: how byte-level vocabularies cut text before any merge. :func:`word_starts` does the same for whole blocks.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: What may follow an apostrophe that begins a word, by length.
SHORTENED = (("s", "t", "m", "d"), ("re", "ve", "ll"))
#: Kinds of characters; what is none of the first three is a sign.
SPACE, LETTER, DIGIT, SIGN = range(4)
#: Bytes of words that a worker remembers (about, and twice: young and old), bytes of the longest, and ends of
#: prefixes; only speed depends on them.
KNOWN_WORDS, KNOWN_LENGTH, KNOWN_ENDINGS = 64 << 20, 192, 100_000
#: What an entry takes besides its key's bytes and its tokens' (two objects and their places in a table).
ENTRY_BYTES = 200


def _byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in such vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and added tokens of a tokenizers JSON file, as far as byte-level BPE uses them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, of = spec["model"], _byte_characters()
        if model["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["normalizer"]:
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        if spec["pre_tokenizer"].get("add_prefix_space") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError(f"{path} asks for a prefix space, dropout or whole-word lookup")
        self.size = 1 + max([*model["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
        self.bytes_of = [b""] * self.size
        for token, number in model["vocab"].items():
            self.bytes_of[number] = bytes(of[c] for c in token)
        self.number = {self.bytes_of[n]: n for n in model["vocab"].values()}
        self.rank = [-1] * self.size  # of the merge that makes a token; single bytes have none
        self.left, self.right = list(range(self.size)), list(range(self.size))
        self.merged: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, z = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            if self.rank[z] >= 0:
                raise ValueError(f"two merges make token {z}")
            self.rank[z], self.left[z], self.right[z], self.merged[x, y] = rank, x, y, rank
        self.special = {}
        for token in spec["added_tokens"]:
            if token["lstrip"] or token["rstrip"] or token["single_word"] or token["normalized"]:
                raise ValueError(f"added token {token['id']} needs its surroundings")
            self.special[token["content"]] = token["id"]
            self.bytes_of[token["id"]] = token["content"].encode()
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.longest = max(map(len, self.number), default=1)
        self.root = self.size  # stands for the empty prefix
        self.endings: dict[int, list[tuple[int, int, dict[int, bool]]]] = {}  # last token << 8 | next byte
        self.whole: dict[int, bool] = {}

    def stay_apart(self, a: int, b: int, before: int | None = None) -> bool:
        """Whether tokens a and b, encoded side by side, stay two tokens (in merges before a rank).

        Walks back in time along the right edge of a and the left edge of b. Each pair that once faced
        the border must not have had a merge that came before one of the two was merged further.
        """
        never = len(self.merged) + 1
        left_until = right_until = never if before is None else before
        while True:
            rank = self.merged.get((a, b))
            # of merges of one rank the leftmost comes first: the border before its right neighbour
            if rank is not None and rank < left_until and rank <= right_until:
                return False
            made_a, made_b = self.rank[a], self.rank[b]
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                left_until, a = made_a, self.right[a]
            else:
                right_until, b = made_b, self.left[b]

    def _is_whole(self, token: int) -> bool:
        """Whether a token's own bytes are encoded as that token."""
        known = self.whole.get(token)
        if known is None:
            if self.rank[token] < 0:
                known = len(self.bytes_of[token]) == 1
            else:
                a, b = self.left[token], self.right[token]
                known = self._is_whole(a) and self._is_whole(b) and self.stay_apart(a, b, self.rank[token])
            self.whole[token] = known
        return known

    def _ending(self, token: int, byte: int) -> list[tuple[int, int, dict[int, bool]]]:
        """Tokens that end the bytes of a token and one more byte, longest first: number, length, verdicts.

        A verdict says whether the token stays apart from the token on its left; it does from the root.
        """
        whole = self.bytes_of[token] + bytes([byte]) if token != self.root else bytes([byte])
        found = [(self.number.get(whole[i:]), len(whole) - i) for i in range(len(whole))]
        return [(t, n, {self.root: True}) for t, n in found if t is not None and self._is_whole(t)]

    def encode_words(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """The tokens of each word; words share the work on common prefixes.

        Sorted words are the trie in depth-first order: ``last`` holds the last tokens of the prefixes on
        the branch of the current word, and only what a word does not share with the one before is added.
        """
        out: list[tuple[int, ...]] = [()] * len(words)
        endings, bytes_of = self.endings, self.bytes_of
        if len(endings) > KNOWN_ENDINGS:
            endings.clear()
        last, before = [self.root], b""
        for k in sorted(range(len(words)), key=words.__getitem__):
            word = words[k]
            depth = _shared(before, word)
            del last[depth + 1 :]
            token, before = last[depth], word
            for byte in word[depth:]:
                edge = token << 8 | byte
                choice = endings.get(edge)
                if choice is None:
                    choice = endings[edge] = self._ending(token, byte)
                for token, length, verdicts in choice:
                    left = last[-length]
                    verdict = verdicts.get(left)
                    if verdict:
                        break
                    if verdict is None:
                        verdict = verdicts[left] = self.stay_apart(left, token)
                        if verdict:
                            break
                else:
                    token = self._longer(word, len(last), choice[0][1] if choice else 0, last)
                last.append(token)
            tokens, depth = [], len(word)
            while depth:
                token = last[depth]
                tokens.append(token)
                depth -= len(bytes_of[token])
            out[k] = tuple(tokens[::-1])
        return out

    def _longer(self, word: bytes, depth: int, length: int, last: list[int]) -> int:
        """The last token of a prefix where it is longer than the last token before and one byte."""
        for size in range(length + 1, min(depth, self.longest) + 1):
            token = self.number.get(word[depth - size : depth])
            if token is not None and self._is_whole(token):
                if size == depth or self.stay_apart(last[depth - size], token):
                    return token
        raise ValueError(f"no token ends {word[:depth]!r}")


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


class Recent:
    """Remembers the bytes made for keys, but for long ones. When it is full, what was not used since it was last full goes."""

    def __init__(self, limit: int, make: Callable[[list[bytes]], Iterable[bytes]]):
        self.limit, self.make = limit, make
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.held = 0

    def recall(self, keys: list[bytes]) -> list[bytes]:
        """What belongs to each of some distinct keys, made where it is not remembered."""
        if self.held > self.limit:
            self.old, self.young, self.held = self.young, {}, 0
        found = list(map(self.young.get, keys))
        missing = [at for at, value in enumerate(found) if value is None]
        new = []
        for at in missing:
            found[at] = self.old.get(keys[at])
            if found[at] is None:
                new.append(at)
        for at, value in zip(new, self.make([keys[at] for at in new]), strict=True):
            found[at] = value
        kept = [at for at in missing if len(keys[at]) <= KNOWN_LENGTH]
        self.young.update((keys[at], found[at]) for at in kept)
        self.held += ENTRY_BYTES * len(kept) + sum(len(keys[at]) + len(found[at]) for at in kept)
        return found


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """The kind of each character, by its code point."""
    kinds = np.full(0x110000, SIGN, np.uint8)
    every = np.arange(len(kinds), dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
    for kind, pattern in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+")):
        for run in regex.finditer(pattern, every):
            kinds[slice(*run.span())] = kind
    return kinds


def word_starts(codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Places where the words of :data:`WORD_PATTERN` begin, in code points of texts in a row that begin at ``begins``.

    Words begin where the kind of character changes. The last of some white space goes to the word behind it
    if it is a space, else it is a word of its own. An apostrophe that begins a word takes a shortened form.
    """
    kinds = _kinds()[codes]
    first, start = np.zeros(len(codes) + 1, bool), np.ones(len(codes) + 1, bool)
    first[begins] = True
    np.not_equal(kinds[1:], kinds[:-1], out=start[1:-1])
    start |= first
    blank = kinds == SPACE
    behind = np.flatnonzero(blank[:-1] & ~blank[1:] & ~first[1:-1])  # last of white space before something else
    start[behind] = True
    start[behind[codes[behind] == ord(" ")] + 1] = False
    marks = np.flatnonzero(codes == ord("'"))
    if len(marks):
        # two characters more than there are; a part that begins ends what is before it
        ahead = np.concatenate([codes, np.zeros(3, codes.dtype)])
        ends = np.concatenate([first, np.ones(3, bool)])
        marks = marks[start[marks] & ~ends[marks + 1]]
        one, two = ahead[marks + 1], np.where(ends[marks + 2], 0, ahead[marks + 2])
        for size, forms in enumerate(SHORTENED, 1):
            for form in forms:
                found = marks[(one == ord(form[0])) & ((two == ord(form[1])) if size == 2 else True)]
                start[found + 1] = False
                start[found + 1 + size] = True
    return np.flatnonzero(start[:-1])


class Codec:
    """Encodes and decodes lists of texts; keeps the tokens of words it has met lately."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.known = self.chunks = Recent(KNOWN_WORDS, self._pack)  # words are the only chunks
        spelled = self.vocabulary.bytes_of
        self.lengths = np.fromiter(map(len, spelled), np.int64, len(spelled))
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.spelling = np.frombuffer(b"".join(spelled), np.uint8)

    def _pack(self, words: list[bytes]) -> list[bytes]:
        """Tokens of words as 32-bit numbers in a row."""
        return [array("i", tokens).tobytes() for tokens in self.vocabulary.encode_words(words)]

    def encode_block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All tokens in a row, and where each text's tokens end."""
        special, cut = self.vocabulary.special, self.vocabulary.cut
        parts: list[str] = []
        reach = []  # number of parts up to each text's end
        marks: list[tuple[int, int]] = []  # parts that are added tokens
        for text in texts:
            if any(s in text for s in special):
                for part in filter(None, cut.split(text)):
                    if part in special:
                        marks.append((len(parts), special[part]))
                        part = " "  # one word, whose token is replaced below
                    parts.append(part)
            elif text:
                parts.append(text)
            reach.append(len(parts))
        whole = "".join(parts)
        if not whole:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        data = whole.encode()
        raw, codes = np.frombuffer(data, np.uint8), np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        begins = np.cumsum([0, *map(len, parts)])  # the last one is the end
        starts = word_starts(codes, begins[:-1])
        offsets = np.append(starts if len(raw) == len(codes) else np.flatnonzero((raw & 0xC0) != 0x80)[starts], len(raw))
        words = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
        ).dictionary_encode()
        found = self.known.recall(words.dictionary.to_pylist())
        which = words.indices.to_numpy().astype(np.int64)
        for part, token in marks:
            which[np.searchsorted(starts, begins[part])] = len(found)
            found.append(array("i", [token]).tobytes())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        tokens, word_ends = _gather(np.frombuffer(b"".join(found), np.int32), np.cumsum(sizes) - sizes, sizes, which)
        return tokens, np.append(0, word_ends)[np.searchsorted(starts, begins[reach])]

    def encode(self, texts: list[str]) -> tuple[list[int], list[int]]:
        """As :meth:`encode_block`, in lists."""
        tokens, ends = self.encode_block(texts)
        return tokens.tolist(), ends.tolist()

    def decode(self, tokens: list[int]) -> str:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, tokens)).decode("utf-8", "replace")

    def decode_block(self, tokens: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The text of each stretch of tokens."""
        raw, token_ends = _gather(self.spelling, self.begins, self.lengths, tokens)
        offsets, data = np.append(0, token_ends)[np.append(0, ends)], raw.tobytes()
        try:
            data.decode()
            sound = not np.any((raw[offsets[offsets < len(raw)]] & 0xC0) == 0x80)
        except UnicodeDecodeError:
            sound = False
        if not sound:
            return pa.array([data[a:b].decode("utf-8", "replace") for a, b in pairwise(offsets)], pa.string())
        return pa.Array.from_buffers(
            pa.large_string(), len(ends), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
        ).cast(pa.string())


def _gather(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``values`` that ``which`` names, in a row, and where each ends there."""
    counts = sizes[which]
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(begins[which] - ends + counts, counts)
    at += np.arange(total)
    return values[at], ends


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker and vocabulary."""
    return Codec(path)


ENCODED = T.StructType([T.StructField("token_ids", T.ArrayType(T.IntegerType(), False), False)])
DECODED = T.StructType([T.StructField("decoded_text", T.StringType(), False)])


def _token_lists(tokens: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(tokens))


def encode_documents(docs: DataFrame, path: str, text_column: str = "text", keep_text: bool = True) -> DataFrame:
    """Rows with ``token_ids``, the tokens of the whole text under the vocabulary file at ``path``.

    Strings of added tokens inside a text become those tokens; none is added besides. A null or empty
    text has no tokens. Repeated rows are encoded each; an input column ``token_ids`` is replaced. The
    vocabulary file must be present on each worker.
    """

    def compute(texts: list[str | None]) -> list[pa.Array]:
        return [_token_lists(*codec(path).encode_block([t or "" for t in texts]))]

    return append_columns(docs, text_column, ENCODED, compute, keep_source=keep_text)


def decode_documents(encoded: DataFrame, path: str, ids_column: str = "token_ids") -> DataFrame:
    """Rows with ``decoded_text``, the text of the tokens in ``ids_column`` (null or none: empty).

    Bytes that are not UTF-8 become U+FFFD, which whole texts never need. An input column
    ``decoded_text`` is replaced.
    """

    def compute(lists: list[list[int] | None]) -> list[pa.Array]:
        known = codec(path)
        return [pa.array([known.decode(x or []) for x in lists], pa.string())]

    return append_columns(encoded, ids_column, DECODED, compute, "array<int>")


def round_trip(docs: DataFrame, path: str, text_column: str = "text", keep_text: bool = True) -> DataFrame:
    """Both of the above in one pass: ``token_ids``, and ``decoded_text`` made from these tokens alone."""

    def compute(texts: list[str | None]) -> list[pa.Array]:
        known = codec(path)
        tokens, ends = known.encode_block([t or "" for t in texts])
        return [_token_lists(tokens, ends), known.decode_block(tokens, ends)]

    return append_columns(docs, text_column, T.StructType([*ENCODED.fields, *DECODED.fields]), compute, keep_source=keep_text)
