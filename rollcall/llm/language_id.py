"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
The probability of a word is the sum, over all ways to write it as pieces, of
the product of their probabilities; a forward pass over the whole word, however
long, gives that sum without listing the ways. The probabilities are learned by expectation maximisation over
the words of labelled documents; no tokenizer is trained.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import Memo, Words, mix, slices, stored

# Documents per language that the model is fitted on: a sample by hash of about
# this size, for the pieces of the common languages are known long before.
TRAIN_DOCUMENTS = 1500
ROUNDS = 4
SMOOTHING = 0.05
# Words of at most so many bytes are scored in plain numbers; longer ones with a
# window that moves along the word, and their probabilities in logarithms.
SHORT = 32
# Places of a long word whose pieces are looked up at once.
SEGMENT = 4096
UNKNOWN = "und"
MEMO_WORDS = 300_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_LETTER = re.compile(r"[^\W\d_]")


def default_path() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """The pieces as byte strings, a space before those that begin a word."""

    def __init__(self, path: str):
        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {bytes([b]) for b in range(256)}
        for i in range(processor.get_piece_size()):
            if processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i):
                continue
            piece = processor.id_to_piece(i).replace("▁", " ").encode()
            # A word has one space, at its begin.
            if b" " not in piece[1:]:
                pieces.add(piece)
        codes = np.array([self._code(p) for p in sorted(pieces)], np.uint64)
        self.codes = np.sort(codes)
        self.size = len(self.codes)
        self.longest = max(map(len, pieces))
        self._maybe = np.zeros(1 << 22, bool)
        self._maybe[self.codes >> np.uint64(42)] = True

    @staticmethod
    def _code(piece: bytes) -> int:
        code = np.zeros(1, np.uint64)
        for b in piece:
            code = code * _STEP + _CODES[b]
        return int(mix(code)[0])

    def lattice(self, letters: np.ndarray) -> list[np.ndarray]:
        """Per length, the piece that begins at each place of each word, or ``size``."""
        out, code = [], np.zeros(letters.shape, np.uint64)
        for length in range(1, min(self.longest, letters.shape[1]) + 1):
            places = letters.shape[1] - length + 1
            code = code[:, :places] * _STEP + _CODES[letters[:, length - 1 :]]
            mixed = mix(code)
            found = np.full(code.shape, self.size, np.int32)
            at = np.nonzero(self._maybe[mixed >> np.uint64(42)])
            index = np.minimum(np.searchsorted(self.codes, mixed[at]), self.size - 1)
            found[at] = np.where(self.codes[index] == mixed[at], index, self.size)
            out.append(found)
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _blocks(words: list[bytes], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places among the words, letters, lengths) of words of like length, with their leading space.

    At most ``size`` words, and fewer of long ones.
    """
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    order = np.argsort(lengths, kind="stable")
    start = 0
    while start < len(order):
        # Short and long words do not share a block.
        longest = SHORT if lengths[order[start]] <= SHORT else max(2 * lengths[order[start]], SHORT)
        room = size if longest == SHORT else max(1, size * SHORT // int(longest))
        stop = min(start + room, int(np.searchsorted(lengths[order], longest, "right")))
        at = order[start : max(stop, start + 1)]
        width = int(lengths[at[-1]])
        letters = np.zeros((len(at), width), np.uint8)
        for row, i in enumerate(at):
            letters[row, : lengths[i]] = np.frombuffer(b" " + words[i], np.uint8)
        yield at, letters, lengths[at]
        start += len(at)


def _pieces_along(letters: np.ndarray, vocab: Vocabulary) -> Iterator[tuple[int, list[tuple[int, np.ndarray]]]]:
    """Place by place, the (length, piece of each word) that begin there in any of the words."""
    width = letters.shape[1]
    for start in range(0, width, SEGMENT):
        lattice = vocab.lattice(letters[:, start : start + SEGMENT + vocab.longest - 1])
        places = min(SEGMENT, width - start)
        begins: list[list] = [[] for _ in range(places)]
        for length, found in enumerate(lattice, 1):
            found = found[:, :places]
            for place in np.flatnonzero((found != vocab.size).any(0)).tolist():
                begins[place].append((length, found[:, place]))
        for place, pieces in enumerate(begins):
            yield start + place, pieces


def _long_scores(letters: np.ndarray, lengths: np.ndarray, vocab: Vocabulary, table: np.ndarray) -> np.ndarray:
    """Log-probability of long words over all their segmentations: words x languages.

    Only the probabilities up to the next places are held, as many as the longest
    piece has bytes; they are scaled, word by word and language by language.
    """
    n, width, around = len(letters), letters.shape[1], vocab.longest + 1
    ring = np.zeros((around, n, table.shape[1]))
    ring[0] = 1
    scale, out = np.zeros((n, table.shape[1])), np.zeros((n, table.shape[1]))

    def take(place):
        done = lengths == place
        if done.any():
            out[done] = np.log(ring[place % around][done]) + scale[done]

    for place, pieces in _pieces_along(letters, vocab):
        take(place)
        if place % 8 == 0:
            most = ring.max(0)
            most[most == 0] = 1
            ring /= most
            scale += np.log(most)
        here = ring[place % around].copy()
        ring[place % around] = 0
        for length, found in pieces:
            ring[(place + length) % around] += here * table[found]
    take(width)
    return out


def _long_expected(word: np.ndarray, vocab: Vocabulary, probabilities: np.ndarray) -> np.ndarray:
    """How often each piece is used in one long word, over all its segmentations."""
    width = len(word)
    logs = np.log(np.append(probabilities, 1.0))
    begins = [[(n, int(f[0])) for n, f in pieces] for _, pieces in _pieces_along(word[None], vocab)]
    # Logarithms of the summed probabilities of all that leads to a place, and on from it.
    before, after = [-math.inf] * (width + 1), [-math.inf] * (width + 1)
    before[0] = after[width] = 0.0
    for place in range(width):
        for n, piece in begins[place]:
            before[place + n] = _log_add(before[place + n], before[place] + logs[piece])
    for place in range(width - 1, -1, -1):
        for n, piece in begins[place]:
            after[place] = _log_add(after[place], logs[piece] + after[place + n])
    counts = np.zeros(vocab.size + 1)
    for place in range(width):
        for n, piece in begins[place]:
            counts[piece] += math.exp(before[place] + logs[piece] + after[place + n] - before[width])
    return counts


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a)) if b > -math.inf else a


def _forward(lattice: list[np.ndarray], width: int, table: np.ndarray) -> np.ndarray:
    """Summed probability of all segmentations up to each place: words x places x languages."""
    alpha = np.zeros((len(lattice[0]), width + 1, table.shape[1]))
    alpha[:, 0] = 1
    for place in range(1, width + 1):
        for length in range(1, min(place, len(lattice)) + 1):
            alpha[:, place] += alpha[:, place - length] * table[lattice[length - 1][:, place - length]]
    return alpha


def word_scores(words: list[bytes], vocab: Vocabulary, table: np.ndarray) -> np.ndarray:
    """Log-probability of each word in each language."""
    scores = np.zeros((len(words), table.shape[1]))
    for at, letters, lengths in _blocks(words, max(256, 16384 // max(table.shape[1], 1))):
        if letters.shape[1] > SHORT:
            scores[at] = _long_scores(letters, lengths, vocab, table)
            continue
        alpha = _forward(vocab.lattice(letters), letters.shape[1], table)
        scores[at] = np.log(alpha[np.arange(len(at)), lengths])
    return scores


def _expected(words: list[bytes], times: np.ndarray, vocab: Vocabulary, probabilities: np.ndarray) -> np.ndarray:
    """How often each piece is used in the words, over all segmentations."""
    table = np.append(probabilities, 0.0)[:, None]
    counts = np.zeros(vocab.size + 1)
    for at, letters, lengths in _blocks(words, 8192):
        if letters.shape[1] > SHORT:
            for row, i in enumerate(at):
                counts += times[i] * _long_expected(letters[row, : lengths[row]], vocab, probabilities)
            continue
        lattice, width = vocab.lattice(letters), letters.shape[1]
        alpha = _forward(lattice, width, table)[:, :, 0]
        beta = np.zeros((len(at), width + 1))
        rows = np.arange(len(at))
        beta[rows, lengths] = 1
        for place in range(width - 1, -1, -1):
            for length in range(1, min(width - place, len(lattice)) + 1):
                beta[:, place] += table[lattice[length - 1][:, place], 0] * beta[:, place + length]
        share = times[at] / alpha[rows, lengths]
        for length, found in enumerate(lattice, 1):
            places = found.shape[1]
            use = alpha[:, :places] * table[found, 0] * beta[:, length : length + places] * share[:, None]
            counts += np.bincount(found.ravel(), use.ravel(), minlength=vocab.size + 1)
    return counts[:-1]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        words = Words(batch.column("text"), lower=False)
        if not len(words.starts):
            continue
        langs, lang = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True)
        keys = mix(words.hashes() + lang[words.rows].astype(np.uint64) * _STEP)
        _, first, n = np.unique(keys, return_index=True, return_counts=True)
        data = words.data.tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(langs[lang[words.rows[first]]], pa.string()),
                pa.array([data[a:b] for a, b in zip(words.starts[first], words.ends[first])], pa.binary()),
                pa.array(n.astype(np.int64)),
            ],
            ["lang", "word", "n"],
        )


def _expect(path: str, langs: list[str], probabilities: np.ndarray):
    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, place = vocabulary(path), {x: i for i, x in enumerate(langs)}
        totals = np.zeros((len(langs), vocab.size))
        for batch in batches:
            lang = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64)
            words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy(zero_copy_only=False)
            for i in np.unique(lang):
                own = np.flatnonzero(lang == i)
                totals[i] += _expected([words[j] for j in own], n[own].astype(float), vocab, probabilities[i])
        at = np.nonzero(totals > 1e-9)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[0].astype(np.int32)), pa.array(at[1].astype(np.int32)), pa.array(totals[at])],
            ["lang", "piece", "n"],
        )

    return expect


def train(labelled: DataFrame, path: str | None = None, documents: int = TRAIN_DOCUMENTS) -> tuple[list[str], np.ndarray]:
    """Languages, and for each the probability of every piece.

    ``labelled`` has text and lang; rows without either teach nothing. About
    ``documents`` of each language, chosen by hash, are learned from as a whole.
    The driver sees one number per language and piece. No rows, no languages.
    """
    path = path or default_path()
    rows = labelled.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    counts = {r[0]: r[1] for r in rows.groupBy("lang").agg(F.count("*")).collect()}
    langs = sorted(counts)
    vocab = vocabulary(path)
    probabilities = np.full((len(langs), vocab.size), 1 / vocab.size)
    if not langs:
        return langs, probabilities
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, documents / counts[k]))])
    chosen = rows.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)
    words = stored(
        chosen.mapInArrow(_count_words, "lang STRING, word BINARY, n BIGINT")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n")),
        "words",
    )
    for _ in range(ROUNDS):
        used = words.mapInArrow(_expect(path, langs, probabilities), "lang INT, piece INT, n DOUBLE")
        found = np.full((len(langs), vocab.size), SMOOTHING)
        for r in used.groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect():
            found[r["lang"], r["piece"]] += r["n"]
        probabilities = found / found.sum(1, keepdims=True)
    return langs, probabilities


def _predictor(path: str, langs: list[str], probabilities: np.ndarray):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, memo = vocabulary(path), Memo(MEMO_WORDS)
        table = np.vstack([probabilities.T, np.zeros((1, len(langs)))])
        for batch in slices(batches):
            words = Words(batch.column("text"), lower=False)
            totals = np.zeros((batch.num_rows, len(langs)))
            if len(words.starts) and langs:
                keys, first, place = np.unique(words.hashes(), return_index=True, return_inverse=True)
                data = words.data.tobytes()

                def compute(missing):
                    at = first[missing]
                    return word_scores([data[a:b] for a, b in zip(words.starts[at], words.ends[at])], vocab, table)

                scores = memo.get(keys, compute)
                filled = np.flatnonzero(words.counts)
                totals[filled] = np.add.reduceat(scores[place], words.bounds[:-1][filled], axis=0)
            letters = [t is not None and _LETTER.search(t) is not None for t in batch.column("text").to_pylist()]
            known = np.array(letters, bool) & bool(langs)
            if langs:
                shares = np.exp(totals - totals.max(1, keepdims=True))
                shares /= shares.sum(1, keepdims=True)
                best = shares.argmax(1)
                names = np.where(known, np.array(langs, object)[best], UNKNOWN)
                score = np.where(known, shares[np.arange(len(best)), best], 0.0)
            else:
                names, score = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(names.tolist(), pa.string()),
                    pa.array(score, pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return predict


def predict(rows: DataFrame, model: tuple[list[str], np.ndarray], path: str | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score (the language's share of the probability).

    ``rows`` has doc_id, text, held_out. A text that is null or has no letter is
    ``und`` with score 0, and so is every text of a model without languages. Of
    equal languages the first by name is taken.
    """
    return rows.select("doc_id", "text", "held_out").mapInArrow(
        _predictor(path or default_path(), *model), "doc_id BIGINT, held_out BOOLEAN, lang_pred STRING, score DOUBLE"
    )
