"""Exact byte-level BPE ids by a program over prefixes.

A byte-level BPE has exactly one last token for every prefix of a word: the one vocabulary entry that ends the prefix
and that the merges would keep beside the last token of what remains. Two tokens may stand side by side if undoing their
merges, latest first, never meets a pair across the border that would have merged earlier. So one pass over a word with
a suffix automaton of the vocabulary fills a table of last tokens, and following it backwards gives the ids. The cost
is linear in the word for a given vocabulary, so that a megabyte without blanks takes no worse a turn than prose.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from pathlib import Path

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType

TOKENIZER_DIR = "/opt/tokenizers"
TOKENIZER_FILE = "byte_bpe_50k.json"

# Fixed value: the published pattern that cuts a text into words before merging.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_CACHED_WORD = 48
_CACHED_WORDS = 200_000
_CACHED_PAIRS = 400_000


def byte_alphabet() -> dict[str, int]:
    """The printable character that vocabulary files write for each byte: itself if printable, else the next from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixEncoder:
    """Encoder for a vocabulary in which every token is a byte or the merge of two earlier tokens."""

    def __init__(self, vocabulary: dict[str, int], merges: Iterable[tuple[str, str]], words: str = WORDS) -> None:
        alphabet = byte_alphabet()
        # Bytes are kept as Latin-1 text, on which the automaton works.
        latin = {t: "".join(chr(alphabet[c]) for c in t) for t in vocabulary if all(c in alphabet for c in t)}
        self.left = list(range(1 + max(vocabulary.values())))
        self.right = self.left.copy()
        self.rank = [-1] * len(self.left)  # of single bytes: before all merges
        self.joined: dict[int, int] = {}
        for n, (a, b) in enumerate(merges):
            i, j, both = vocabulary[a], vocabulary[b], vocabulary[a + b]
            if self.rank[both] < 0:
                self.left[both], self.right[both], self.rank[both] = i, j, n
            self.joined[i << 20 | j] = n
        self.pairs: dict[int, bool] = {}
        self.seen: dict[str, tuple[int, ...]] = {}
        self.automaton = ahocorasick.Automaton()
        for token, text in latin.items():
            i = vocabulary[token]
            if len(text) == 1 or self.rank[i] >= 0 and self._beside(self.left[i], self.right[i], self.rank[i]):
                self.automaton.add_word(text, (len(text), i))
        self.automaton.make_automaton()
        self.words = regex.compile(words)

    @classmethod
    def from_json(cls, content: bytes) -> PrefixEncoder:
        model = json.loads(content)["model"]
        return cls(model["vocab"], (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]))

    def _beside(self, a: int, b: int, before: int = 1 << 30) -> bool:
        """Whether merging leaves tokens a and b side by side: no pair across their border merges earlier than they were made."""
        rank, left, right, joined = self.rank, self.left, self.right, self.joined
        while True:
            if joined.get(a << 20 | b, before) < before:
                return False
            # Undo the later merge of the two; a pair at the border then existed before that merge was made.
            if rank[a] < 0 and rank[b] < 0:
                return True
            if rank[a] > rank[b]:
                before = min(before, rank[a])
                a = right[a]
            else:
                before = min(before, rank[b] + 1)
                b = left[b]

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of one word."""
        text = word.encode().decode("latin-1")
        last = [-1] * (len(text) + 1)
        size = [0] * (len(text) + 1)
        pairs = self.pairs
        for end, (n, token) in self.automaton.iter(text):
            at = end + 1
            if last[at] >= 0:
                continue
            if at > n:
                before = last[at - n]
                if before < 0:
                    continue
                key = before << 20 | token
                fits = pairs.get(key)
                if fits is None:
                    fits = pairs[key] = self._beside(before, token)
                if not fits:
                    continue
            last[at], size[at] = token, n
        if len(pairs) > _CACHED_PAIRS:
            pairs.clear()
        ids, at = [], len(text)
        while at:
            ids.append(last[at])
            at -= size[at]
        return tuple(reversed(ids))

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; an empty list for an empty or a null one. Special tokens' strings are ordinary text."""
        ids: list[int] = []
        if not text:
            return ids
        seen = self.seen
        for m in self.words.finditer(text):
            w = m.group()
            got = seen.get(w)
            if got is None:
                got = self.word(w)
                if len(w) <= _CACHED_WORD:
                    if len(seen) >= _CACHED_WORDS:
                        seen.clear()
                    seen[w] = got
            ids += got
        return ids


_encoders: dict[int, PrefixEncoder] = {}


def _encoder(content: bytes) -> PrefixEncoder:
    """One encoder for each vocabulary and worker process."""
    key = hash(content)
    if key not in _encoders:
        _encoders[key] = PrefixEncoder.from_json(content)
    return _encoders[key]


def tokenizer_content(directory: str = TOKENIZER_DIR, name: str = TOKENIZER_FILE) -> bytes:
    """The vocabulary file, read once on the driver; it goes to the tasks with the function (under 2 MB)."""
    return Path(directory, name).read_bytes()


def token_ids(text: Column, content: bytes) -> Column:
    """array<int> of a text's ids; empty for null and empty texts."""

    def encode(texts: pa.Array) -> pa.Array:
        enc = _encoder(content)
        return pa.array([enc.encode(t.as_py()) for t in texts], pa.list_(pa.int32()))

    return F.arrow_udf(encode, ArrayType(IntegerType()))(text)


def token_count(text: Column, content: bytes) -> Column:
    """Number of ids (bigint); 0 for null and empty texts."""

    def count(texts: pa.Array) -> pa.Array:
        enc = _encoder(content)
        return pa.array([len(enc.encode(t.as_py())) for t in texts], pa.int64())

    return F.arrow_udf(count, LongType())(text)
