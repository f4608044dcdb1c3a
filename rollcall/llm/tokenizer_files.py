"""Public byte-pair vocabularies, run by the ``tiktoken`` engine.

A ``.json`` vocabulary of the ``tokenizers`` library names its merges in the
order of their ids, so the ids are the ranks that ``tiktoken`` needs. It gives
the same ids several times faster. The tests hold it against ``tokenizers``.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

# How byte-level vocabularies write bytes as characters (printable
# Latin-1 as itself, the others from U+0100 on), and the splitting patterns.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"

# How many words, and ids of words, a task keeps; more only take computing again.
MEMO_WORDS = 400_000
MEMO_IDS = 8_000_000


def version_of(path: str) -> str:
    """Digest of the vocabulary file: counts of another version are other counts."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def _byte_values() -> dict[str, int]:
    values = {chr(b): b for b in PRINTABLE}
    others = [b for b in range(256) if b not in set(PRINTABLE)]
    return values | {chr(0x100 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def byte_encoding(path: str) -> tiktoken.Encoding:
    """The byte-level vocabulary at ``path``, with its special strings."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    values = _byte_values()
    ranks = {
        bytes(values[c] for c in token): i
        for token, i in spec["model"]["vocab"].items()
        if token not in special
    }
    return tiktoken.Encoding("bytes", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens=special)


@lru_cache(maxsize=4)
def library(path: str) -> Tokenizer:
    """The vocabulary at ``path`` in the ``tokenizers`` library, for whole texts."""
    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


class WordEncoder:
    """Ids of words by a vocabulary with word ends, lower case, white space dropped.

    No token of this vocabulary spans white space, so a text's ids are those of
    its words one after the other. Each distinct word is encoded once per task.
    A word of letters beyond U+024F, control characters or special strings goes
    through the ``tokenizers`` library itself.
    """

    # A newline stands for the end of a piece, a carriage return for that of a word.
    _plain = regex.compile(r"[!-~\u00a1-\u00ac\u00ae-\u012f\u0131-\u024f]+")
    _pieces = regex.compile(WORD_PATTERN)

    def __init__(self, path: str):
        from .texts import Memo

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._special = [t["content"] for t in spec["added_tokens"]]
        values = _byte_values()
        ranks = {}
        for token, i in spec["model"]["vocab"].items():
            if token in self._special:
                continue
            bare = token.removesuffix(WORD_END)
            ranks[bytes(values[c] for c in bare) + b"\n" * (bare != token)] = i
        self._return = ranks[b"\r"]
        self._engine = tiktoken.Encoding(
            "words", pat_str=r"[^\n\r]*\n|\r", mergeable_ranks=ranks, special_tokens={}
        )
        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        self._memo = Memo(MEMO_WORDS)
        self._pool = np.zeros(0, np.uint32)

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word."""
        plain = [
            self._plain.fullmatch(w) is not None and not any(s in w for s in self._special)
            for w in words
        ]
        joined = "".join(f"{w}\r" for w, ok in zip(words, plain) if ok).lower()
        ids = np.array(self._engine.encode_ordinary(self._pieces.sub("\\g<0>\n", joined)), np.uint32)
        ends = np.flatnonzero(ids == self._return)
        starts = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1]) if len(ends) else ends
        spans = iter(zip(starts, ends))
        others = iter(
            self._library.encode_batch(
                [w for w, ok in zip(words, plain) if not ok], add_special_tokens=False
            )
            if not all(plain)
            else []
        )
        out = []
        for ok in plain:
            if ok:
                a, b = next(spans)
                out.append(ids[a:b])
            else:
                out.append(np.array(next(others).ids, np.uint32))
        return out

    def encode(self, words) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts of a :class:`~.texts.Words`, and how many each text has."""
        if not len(words.starts):
            return np.zeros(0, np.uint32), np.zeros(len(words.counts), np.int64)
        keys, first, place = np.unique(words.hashes(), return_index=True, return_inverse=True)
        data = words.data.tobytes()

        def compute(missing: np.ndarray) -> np.ndarray:
            at = first[missing]
            texts = [data[a:b].decode() for a, b in zip(words.starts[at], words.ends[at])]
            found = self.encode_words(texts)
            sizes = np.array([len(x) for x in found], np.int64)
            spans = np.empty((len(found), 2), np.int64)
            spans[:, 0] = len(self._pool) + np.cumsum(sizes) - sizes
            spans[:, 1] = sizes
            self._pool = np.concatenate([self._pool, *found])
            return spans

        spans = self._memo.get(keys, compute)
        taken = spans[place]
        ids = self._take(taken)
        if len(self._pool) > MEMO_IDS:
            kept = self._memo.values
            self._pool = self._take(kept)
            self._memo.values = np.column_stack([np.cumsum(kept[:, 1]) - kept[:, 1], kept[:, 1]])
        sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(taken[:, 1])])
        return ids, sums[words.bounds[1:]] - sums[words.bounds[:-1]]

    def _take(self, spans: np.ndarray) -> np.ndarray:
        sizes = spans[:, 1]
        shift = spans[:, 0] - (np.cumsum(sizes) - sizes)
        return self._pool[np.repeat(shift, sizes) + np.arange(sizes.sum())]
