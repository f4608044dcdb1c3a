"""Language-model scores by Katz backoff.

Bigram counts are discounted after Good and Turing; what the discounts free goes
to words not seen after a word, in proportion to the unigram model below, with
weights that make every distribution sum to one exactly. The unigram model is
add-one over all training words and one unknown word.

Bigrams are counted over all training words, the end of a text and its begin (as
a history); one unknown word stands for all others. A caller may ask for the most
frequent words only: then all rarer ones are one class, and such a word has the
probability of its class times its share of the class by the unigram model, whose
counts are of all words. Either way the model is normalised over all words.

Every task knows the ``KNOWN_WORDS`` most frequent words by number. All others
are rare: known by hash, their counts, pairs and weights stay in tables.

Counts live in tables of (space, bucket, keys, counts): unigrams by hash, bigrams
of known words by pair, and the logarithms that rare words add to a score. A pair
has the weight of its history times the probability of its word, unless it was
counted; so its logarithm is that of a rare history, by the history's hash, plus
that of a rare word, plus what counting the pair changes, by the pair's hash.
Scoring deals the corpus's word pairs and rare words to the same buckets, and
streams them past each bucket's counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .texts import Words, digests, mix, slices, stored

# Words with bigrams of their own: all, or as many as a caller asks for.
VOCABULARY = None
# Words that every task knows, the most frequent ones: 16 bytes each. Memory only: the
# others have their counts and pairs in tables.
KNOWN_WORDS = 1 << 18
# Good-Turing discounts hold for counts up to this.
DISCOUNTED = 5
# Words that a task gathers before it sends them on, counts of words it gathers before
# it sums them, and text per bucket.
FLUSH_WORDS = 300_000
HELD_COUNTS = 1 << 19
BUCKET_BYTES = 16 << 20
# A flush has a row for each bucket, so with more buckets more of them are dealt together,
# one for so many buckets and at most as many as a task has room for.
ROW_BUCKETS = 64
MOST_TOGETHER = 8
# Keys in a row: rows stay below a megabyte. Rows go to Spark by about as much.
ROW_KEYS = 1 << 16
BATCH_BYTES = 1 << 20
# What tasks are best given at a time (`spark.sql.execution.arrow.maxBytesPerBatch`): a batch
# lies in memory on either side.
TASK_BYTES = 4 << 20
# The pairs counted most often, which every task is told: 16 bytes each. The tables
# are asked for the others only, so no bucket is asked by all documents.
HOT_PAIRS = 1 << 19
# Counts from here on are told apart by their size only when hot pairs are chosen.
EXACT_COUNTS = 1024

UNIGRAM, BIGRAM, LOGS = 0, 1, 2
_PREFIX = 20  # bits of a hash by which known words are looked up
_PLACES = 20  # bits of a word in a pair
_RARE = np.uint64(1 << _PLACES)  # set in every hash: smaller numbers are known words
_DOCS = 24  # bits of a document in a flush
TABLE_SCHEMA = "space INT, bucket INT, keys BINARY, counts BINARY"
RESULT_SCHEMA = (
    "doc_id BIGINT, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, base_score DOUBLE, score DOUBLE"
)


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte plane after byte plane, as many as the largest needs, and how many these are."""
    if not len(values):
        return b""
    used = max(1, (int(values.max()).bit_length() + 7) // 8)
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :used].T.tobytes() + bytes([used])


def _numbers(data) -> np.ndarray:
    data = np.frombuffer(data, np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    planes = data[:-1].reshape(int(data[-1]), -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : len(planes)] = planes.T
    return out.view("<u8").ravel()


def _pack(values: np.ndarray) -> bytes:
    """Sorted numbers as differences: few bytes each, and smaller when compressed."""
    return _planes(np.diff(values.astype(np.uint64), prepend=np.uint64(0)))


def _unpack(data) -> np.ndarray:
    return np.cumsum(_numbers(data), dtype=np.uint64)


def _pack_small(values: np.ndarray) -> bytes:
    return _planes(np.asarray(values).astype(np.uint64))


def _unpack_small(data) -> np.ndarray:
    return _numbers(data).astype(np.int64)


def _parts(n: int) -> Iterator[slice]:
    """Places of ``n`` packed numbers, as many at once as go into a row."""
    return (slice(a, min(a + ROW_KEYS, n)) for a in range(0, n, ROW_KEYS))


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)


def _by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its keys in their order)."""
    yield from _dealt(_bucket(keys, buckets), buckets)


def _dealt(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of what is in it in their order)."""
    # Numbers of 16 bits are sorted by their digits.
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])
    for b in np.flatnonzero(np.diff(ends)):
        yield int(b), order[ends[b] : ends[b + 1]]


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in their order, and the sums of their counts."""
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(all_keys)
    all_keys, all_counts = all_keys[order], all_counts[order]
    new = np.flatnonzero(np.diff(all_keys, prepend=~all_keys[:1]))
    return all_keys[new], np.add.reduceat(all_counts, new)


@dataclass
class Flush:
    """Words of some whole documents, and the documents."""

    hashes: np.ndarray
    counts: np.ndarray
    codes: np.ndarray | None  # digests of the documents, where they are asked for
    doc_ids: list
    held_out: list

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def _flushes(batches: Iterator[pa.RecordBatch], coded: bool = False) -> Iterator[Flush]:
    held: list[Flush] = []
    size = 0

    def join() -> Flush:
        return Flush(
            np.concatenate([f.hashes for f in held]),
            np.concatenate([f.counts for f in held]),
            np.concatenate([f.codes for f in held]) if coded else None,
            [x for f in held for x in f.doc_ids],
            [x for f in held for x in f.held_out],
        )

    for batch in slices(batches):
        words = Words(batch.column("text"))
        hashes = words.hashes() | _RARE
        held.append(
            Flush(
                hashes,
                words.counts,
                digests(words, hashes) if coded else None,
                batch.column("doc_id").to_pylist(),
                batch.column("held_out").to_pylist(),
            )
        )
        size += len(hashes) + batch.num_rows
        if size >= FLUSH_WORDS:
            yield join()
            held, size = [], 0
    if held:
        yield join()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, counts = [], []

    def rows() -> Iterator[pa.RecordBatch]:
        keys, n = _summed(words, counts)
        for at in _parts(len(keys)):
            yield pa.RecordBatch.from_arrays([pa.array(keys[at].view(np.int64)), pa.array(n[at])], ["word", "n"])

    for flush in _flushes(batches):
        keys, n = np.unique(flush.hashes, return_counts=True)
        words.append(keys)
        counts.append(n.astype(np.int64))
        if sum(map(len, words)) >= HELD_COUNTS:
            yield from rows()
            words, counts = [], []
    if words:
        yield from rows()


@dataclass
class Unigrams:
    """The frequent words, by hash, with the totals of the whole training text."""

    words: np.ndarray
    counts: np.ndarray
    tokens: int  # N, ends included
    types: int  # V, the end included
    documents: int
    apart: bool = False  # whether rare words have pairs of their own, not those of a class

    @property
    def unknown(self) -> int:
        return len(self.words)  # the class of rare words, or any of them

    @property
    def end(self) -> int:
        return len(self.words) + 1

    @property
    def begin(self) -> int:
        return len(self.words) + 2

    @property
    def total(self) -> int:
        return self.tokens + self.types + 1

    @cached_property
    def _first(self) -> np.ndarray:
        """Where the words of each prefix begin, and where the last end."""
        prefixes = (self.words >> np.uint64(64 - _PREFIX)).astype(np.int64)
        return np.concatenate([[0], np.cumsum(np.bincount(prefixes, minlength=1 << _PREFIX))]).astype(np.int32)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        prefixes = (hashes >> np.uint64(64 - _PREFIX)).astype(np.int64)
        at, stop = self._first[prefixes], self._first[prefixes + 1]
        out = np.full(len(hashes), self.unknown)
        left = np.flatnonzero(at < stop)
        # A prefix has few words: all are looked at, one after the other.
        while len(left):
            found = self.words[at[left]] == hashes[left]
            out[left[found]] = at[left[found]]
            left = left[~found]
            at[left] += 1
            left = left[at[left] < stop[left]]
        return out

    def codes(self, hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """What words are in pairs: their numbers, and hashes of rare words that are apart."""
        codes = ids.astype(np.uint64)
        return np.where(ids == self.unknown, hashes, codes) if self.apart else codes

    def probabilities(self) -> np.ndarray:
        """Of each frequent word, the class of rare words, and the end."""
        ones = np.append(self.counts + 1, [0, self.documents + 1]).astype(float)
        ones[self.unknown] = self.total - ones.sum()
        return ones / self.total

    def histories(self) -> np.ndarray:
        """How often each frequent word, the rare class, the end and the begin has a successor."""
        rare = self.tokens - self.documents - int(self.counts.sum())
        return np.append(self.counts, [rare, 0, self.documents]).astype(float)


def _pairs(flush: Flush, unigrams: Unigrams) -> tuple[np.ndarray, ...]:
    """History and word of every pair, and its document; ids of the words, and their documents."""
    ids = unigrams.ids(flush.hashes)
    codes = unigrams.codes(flush.hashes, ids)
    docs = len(flush.counts)
    begins = np.cumsum(flush.counts) - flush.counts + np.arange(docs)
    chain = np.empty(len(codes) + docs, np.uint64)
    is_begin = np.zeros(len(chain), bool)
    is_begin[begins] = True
    chain[is_begin], chain[~is_begin] = np.uint64(unigrams.begin), codes
    after = np.empty_like(chain)
    after[:-1] = chain[1:]
    ends = np.append(begins[1:], len(chain)) - 1
    after[ends] = np.uint64(unigrams.end)
    owner = np.repeat(np.arange(docs), flush.counts + 1)
    return chain, after, owner, ids, flush.rows


def _known(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Whether both words of a pair are known ones."""
    return (history | word) < _RARE


def _pair(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The key of a pair of known words."""
    return (history << np.uint64(_PLACES)) | word


def _owner(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """What has a pair with a rare word: its word if that is rare, else the pair itself."""
    return np.where(word < _RARE, mix(history + mix(word)), word)


def _rare_pair(history: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The key of a pair with a rare word."""
    return mix(history + mix(owner))


def _together(buckets: int) -> int:
    """How many flushes are dealt to the buckets together."""
    return max(1, min(MOST_TOGETHER, buckets // ROW_BUCKETS))


def _batched(rows: Iterator[dict], types: list[tuple[str, pa.DataType]]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``BATCH_BYTES``; a column that a row lacks is null."""
    names = [name for name, _ in types]
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row.values() if isinstance(x, bytes))
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array([r.get(x) for r in held], kind) for x, kind in types], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([r.get(x) for r in held], kind) for x, kind in types], names)


def _count_pairs(unigrams: Unigrams, buckets: int):
    together = _together(buckets)
    types = [("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]

    def rows(pairs: list[np.ndarray], counts: list[np.ndarray]) -> Iterator[dict]:
        keys, n = _summed(pairs, counts) if len(pairs) > 1 else (pairs[0], counts[0])
        for b, at in _by_bucket(keys, buckets):
            yield {"bucket": b, "keys": _pack(keys[at]), "counts": _pack_small(n[at])}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = [], []
        for flush in _flushes(batches):
            history, word, *_ = _pairs(flush, unigrams)
            known = _known(history, word)
            keys, n = np.unique(_pair(history[known], word[known]), return_counts=True)
            pairs.append(keys)
            counts.append(n.astype(np.int32))
            if len(pairs) == together:
                yield from _batched(rows(pairs, counts), types)
                pairs, counts = [], []
        if pairs:
            yield from _batched(rows(pairs, counts), types)

    return count


def _count_rare_pairs(unigrams: Unigrams):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs with a rare word by owner; how often their word occurs, if it is a known one."""
        counts = np.append(unigrams.counts, [0, unigrams.documents])
        for flush in _flushes(batches):
            history, word, *_ = _pairs(flush, unigrams)
            rare = ~_known(history, word)
            history, word = history[rare], word[rare]
            owner = _owner(history, word)
            _, at, n = np.unique(_rare_pair(history, owner), return_index=True, return_counts=True)
            history, word, owner = history[at], word[at], owner[at]
            rare = word >= _RARE
            of_word = counts[np.where(rare, 0, word).astype(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(x.view(np.int64)) for x in (owner, history)),
                    pa.array(n.astype(np.int64)),
                    pa.array(of_word.astype(np.int64), mask=rare),
                ],
                ["owner", "history", "n", "of_word"],
            )

    return count


def _cells(batch: pa.RecordBatch, name: str) -> Iterator:
    """The bytes of a binary column row by row, where they lie (nothing for null)."""
    column = batch.column(name)
    return (column[i].as_buffer() for i in range(batch.num_rows))


def _table_rows(space: int, bucket: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in _parts(len(keys)):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([space], pa.int32()),
                pa.array([bucket], pa.int32()),
                pa.array([_pack(keys[at])], pa.binary()),
                pa.array([counts[at].astype("<f8").tobytes() if space == LOGS else _pack_small(counts[at])], pa.binary()),
            ],
            ["space", "bucket", "keys", "counts"],
        )


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each bucket's counts from rows sorted by bucket.

    What is held is merged whenever it has doubled, so memory follows the distinct
    pairs of a bucket, not how often they were sent.
    """
    bucket, keys, counts, merged = None, [], [], 0

    def rows() -> Iterator[pa.RecordBatch]:
        own, n = _summed(keys, counts)
        yield from _table_rows(BIGRAM, bucket, own, n)

    for batch in batches:
        own_buckets = batch.column("bucket").to_pylist()
        for b, k, c in zip(own_buckets, _cells(batch, "keys"), _cells(batch, "counts")):
            if b != bucket and keys:
                yield from rows()
                keys, counts, merged = [], [], 0
            bucket = b
            keys.append(_unpack(k))
            counts.append(_unpack_small(c))
            if sum(map(len, keys)) > 2 * merged + 1_000_000:
                own, n = _summed(keys, counts)
                keys, counts, merged = [own], [n], len(own)
    if keys:
        yield from rows()


def _rare_table(space: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (word, n) of whole buckets, sorted by bucket, packed."""
        bucket, words, counts = None, [], []

        def rows() -> Iterator[pa.RecordBatch]:
            keys, n = np.concatenate(words), np.concatenate(counts)
            order = np.argsort(keys)
            yield from _table_rows(space, bucket, keys[order], n[order])

        for batch in batches:
            own = batch.column("bucket").to_numpy(zero_copy_only=False)
            keys = batch.column("word").to_numpy(zero_copy_only=False).view(np.uint64)
            n = batch.column("n").to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.diff(own, prepend=own[:1] - 1))
            for a, z in zip(starts, np.append(starts[1:], len(own))):
                if own[a] != bucket and words:
                    yield from rows()
                    words, counts = [], []
                bucket = int(own[a])
                words.append(keys[a:z])
                counts.append(n[a:z])
        if words:
            yield from rows()

    return build


def discounts(of_counts: dict[int, int]) -> np.ndarray:
    """Katz's discount for counts 0 to ``DISCOUNTED`` (by place); larger ones keep theirs.

    From the numbers of pairs seen once, twice and so on. Where these cannot give
    discounts between 0 and 1 that fall with the count (small corpora), half an
    occurrence is taken off each.
    """
    n = [of_counts.get(r, 0) for r in range(DISCOUNTED + 2)]
    out = np.ones(DISCOUNTED + 1)
    plain = np.array([1.0, *(1 - 0.5 / r for r in range(1, DISCOUNTED + 1))])
    if not n[1]:
        return plain
    most = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1]
    if most >= 1:
        return plain
    for r in range(1, DISCOUNTED + 1):
        if not n[r]:
            return plain
        out[r] = ((r + 1) * n[r + 1] / (r * n[r]) - most) / (1 - most)
    return out if ((out[1:] > 0) & (out[1:] <= 1)).all() else plain


def _counts_of_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many pairs have each count; larger counts by their power of two, as negative numbers."""
    small, large = np.zeros(EXACT_COUNTS, np.int64), np.zeros(64, np.int64)
    for batch in batches:
        for data in _cells(batch, "counts"):
            n = _unpack_small(data)
            small += np.bincount(n[n < EXACT_COUNTS], minlength=EXACT_COUNTS)
            large += np.bincount(np.log2(n[n >= EXACT_COUNTS]).astype(np.int64), minlength=64)
    r = np.concatenate([np.arange(EXACT_COUNTS), -np.arange(64)])
    n = np.concatenate([small, large])
    yield pa.RecordBatch.from_arrays([pa.array(r[n > 0]), pa.array(n[n > 0])], ["r", "n"])


def hot_threshold(of_counts: dict[int, int], most: int) -> int:
    """The least count of which, and above, there are at most ``most`` pairs."""
    steps = sorted((2**-r if r < 0 else r, n) for r, n in of_counts.items())
    least, total = 1 << 62, 0
    for r, n in reversed(steps):
        total += n
        if total > most:
            return least
        least = r
    return least


def _hot(least: int):
    def hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, c in zip(_cells(batch, "keys"), _cells(batch, "counts")):
                keys, n = _unpack(k), _unpack_small(c)
                keys, n = keys[n >= least], n[n >= least]
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["pair", "n"])

    return hot


def _seen_mass(unigrams: Unigrams, discount: np.ndarray):
    def mass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower, times = unigrams.probabilities(), unigrams.histories()
        seen, below = np.zeros(len(times)), np.zeros(len(times))
        for batch in batches:
            for k, c in zip(_cells(batch, "keys"), _cells(batch, "counts")):
                keys, n = _unpack(k), _unpack_small(c)
                history, word = _split(keys)
                kept = n * discount[np.where(n <= DISCOUNTED, n, 0)]
                seen += np.bincount(history, kept / times[history], minlength=len(times))
                below += np.bincount(history, lower[word], minlength=len(times))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(seen[at]), pa.array(below[at])], ["history", "seen", "below"]
        )

    return mass


def _split(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (keys >> np.uint64(_PLACES)).astype(np.int64), (keys & np.uint64((1 << _PLACES) - 1)).astype(np.int64)


@dataclass
class Model:
    unigrams: Unigrams
    buckets: int
    discount: np.ndarray
    backoff: np.ndarray  # weight of each history
    scale: np.ndarray  # factor on what each history has seen
    tables: DataFrame | None  # counts by space and bucket
    hot: tuple[np.ndarray, np.ndarray]  # the pairs counted most often, sorted, and their counts

    def seen(self, pairs: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Log-probabilities of pairs that were counted."""
        return _seen_logs(pairs, n, self.discount, self.scale, self.unigrams.histories())


def _seen_logs(pairs, n, discount, scale, times) -> np.ndarray:
    history, _ = _split(pairs)
    kept = n * discount[np.where(n <= DISCOUNTED, n, 0)]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.log10(scale[history] * kept / times[history])


def _kept(discount: np.ndarray) -> Column:
    """What its discount leaves of a count ``n``."""
    small = F.element_at(F.array(*(F.lit(float(x)) for x in discount[1:])), F.col("n").cast("int"))
    return F.col("n") * F.when(F.col("n") <= DISCOUNTED, small).otherwise(1.0)


def _lower(unigrams: Unigrams) -> Column:
    """The probability of a pair's word by the unigram model."""
    return (F.col("of_word") + 1) / unigrams.total


def _rare_pairs(rows: DataFrame, unigrams: Unigrams) -> DataFrame:
    """All pairs with a rare word, counted: (owner, history, n, of_word), the last of the word.

    They are dealt by their word if it is rare, and a rare word occurs as often as
    its pairs; so one exchange counts both.
    """
    found = rows.mapInArrow(_count_rare_pairs(unigrams), "owner BIGINT, history BIGINT, n BIGINT, of_word BIGINT")
    counted = (
        found.repartition("owner")
        .groupBy("owner", "history")
        .agg(F.sum("n").alias("n"), F.max("of_word").alias("of_word"))
    )
    of_word = F.coalesce("of_word", F.sum("n").over(Window.partitionBy("owner")))
    return stored(counted.select("owner", "history", "n", of_word.alias("of_word")), "rare-pairs")


def _of_known_history() -> Column:
    return F.col("history").between(0, int(_RARE) - 1)


def _after_known(unigrams: Unigrams, discount: np.ndarray, backoff: np.ndarray, scale: np.ndarray):
    def logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What counting changes of pairs of a known history and a rare word."""
        factor = scale / np.maximum(unigrams.histories(), 1) / backoff
        for batch in batches:
            owner, history, n, of_word = (batch.column(x).to_numpy() for x in ("owner", "history", "n", "of_word"))
            keys = _rare_pair(history.view(np.uint64), owner.view(np.uint64)).view(np.int64)
            kept = n * discount[np.where(n <= DISCOUNTED, n, 0)]
            change = np.log10(factor[history] * kept * unigrams.total / (of_word + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("bucket"), pa.array(keys), pa.array(change)], ["bucket", "word", "n"]
            )

    return logs


def _after_rare(pairs: DataFrame, unigrams: Unigrams, discount: np.ndarray) -> DataFrame:
    """The weight of each rare history (without owner), and what counting changes of its pairs.

    The weights are those of :func:`_weights`. All pairs of the history are at hand: it
    occurs as often as they do. Some word is never seen after it, if only the unknown one.
    """
    own = Window.partitionBy("bucket", "history")
    summed = (
        pairs.repartition("bucket")
        .select("bucket", "owner", "history", "n", _kept(discount).alias("kept"), _lower(unigrams).alias("lower"))
        .select(
            "bucket", "owner", "history", "lower", "kept",
            F.sum("n").over(own).alias("times"),
            (F.sum("kept").over(own) / F.sum("n").over(own)).alias("seen"),
            F.sum("lower").over(own).alias("below"),
            (F.row_number().over(own.orderBy("owner")) == 1).alias("first"),
        )
    )
    full = 1 - F.col("seen") < 1e-9
    factor = F.when(full, F.col("times") / (F.col("times") + 1) / F.col("seen")).otherwise(1.0)
    weighed = summed.withColumn("factor", factor).withColumn(
        "backoff", (1 - F.col("factor") * F.col("seen")) / (1 - F.col("below"))
    )
    change = F.log10(F.col("factor") * F.col("kept") / F.col("times") / F.col("backoff") / F.col("lower"))
    of_pair = F.struct("owner", change.alias("n"))
    of_history = F.struct(F.lit(None).cast("bigint").alias("owner"), F.log10("backoff").alias("n"))
    entries = F.when(F.col("first"), F.array(of_pair, of_history)).otherwise(F.array(of_pair))
    return weighed.select("bucket", "history", F.explode(entries).alias("entry")).select(
        "bucket", "history", "entry.owner", "entry.n"
    )


def _table_after_rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def keyed() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            history = batch.column("history").to_numpy().view(np.uint64)
            owner = batch.column("owner")
            owners = pc.fill_null(owner, 0).to_numpy(zero_copy_only=False).view(np.uint64)
            of_pair = owner.is_valid().to_numpy(zero_copy_only=False)
            keys = np.where(of_pair, _rare_pair(history, owners), history).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("bucket"), pa.array(keys), batch.column("n")], ["bucket", "word", "n"]
            )

    yield from _rare_table(LOGS)(keyed())


def train(rows: DataFrame, vocabulary: int | None = VOCABULARY) -> Model:
    """Fit the model on rows (doc_id, text, held_out), whole texts of all of them.

    All words have bigrams of their own, or the ``vocabulary`` most frequent ones and
    a class of the others. The driver sees the known words and one weight for each.
    Null texts are an end alone; no rows give a model that knows nothing.
    """
    total = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    buckets = max(1, math.ceil((total[0] or 0) / BUCKET_BYTES))
    counted = stored(
        rows.mapInArrow(_count_words, "word BIGINT, n BIGINT").groupBy("word").agg(F.sum("n").alias("n")), "unigrams"
    )
    sums = counted.agg(F.sum("n"), F.count("*")).first()
    known = KNOWN_WORDS if vocabulary is None else vocabulary
    frequent = counted.orderBy(F.desc("n"), "word").limit(known).toArrow()
    words = frequent["word"].to_numpy().view(np.uint64)
    order = np.argsort(words)
    unigrams = Unigrams(
        words[order],
        frequent["n"].to_numpy()[order],
        (sums[0] or 0) + total[1],
        sums[1] + (total[1] > 0),
        total[1],
        vocabulary is None and sums[1] > len(words),
    )
    pairs = (
        rows.mapInArrow(_count_pairs(unigrams, buckets), "bucket INT, keys BINARY, counts BINARY")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_sum_counts, TABLE_SCHEMA)
    )
    bigrams = stored(pairs, "bigrams")
    of_counts = bigrams.mapInArrow(_counts_of_counts, "r BIGINT, n BIGINT").groupBy("r").agg(F.sum("n").alias("n"))
    found = {r["r"]: r["n"] for r in of_counts.collect()}
    low = {r: found.get(r, 0) for r in range(1, DISCOUNTED + 2)}
    if unigrams.apart:
        rare_pairs = _rare_pairs(rows, unigrams)
        for r in rare_pairs.where(F.col("n") <= DISCOUNTED + 1).groupBy("n").agg(F.count("*").alias("of")).collect():
            low[r["n"]] += r["of"]
    discount = discounts(low)
    # At most HOT_PAIRS, by the threshold.
    hot = bigrams.mapInArrow(_hot(hot_threshold(found, HOT_PAIRS)), "pair BIGINT, n BIGINT").toArrow()
    hot_keys, hot_counts = hot["pair"].to_numpy().view(np.uint64), hot["n"].to_numpy()
    by_key = np.argsort(hot_keys)
    mass = (
        bigrams.mapInArrow(_seen_mass(unigrams, discount), "history BIGINT, seen DOUBLE, below DOUBLE")
        .groupBy("history")
        .agg(F.sum("seen").alias("seen"), F.sum("below").alias("below"))
        .toArrow()
    )
    history, seen, below = (mass[x].to_numpy() for x in ("history", "seen", "below"))
    if unigrams.apart:
        mass = (
            rare_pairs.where(_of_known_history())
            .groupBy("history")
            .agg(F.sum(_kept(discount)).alias("seen"), F.sum(_lower(unigrams)).alias("below"))
            .toArrow()
        )
        own = mass["history"].to_numpy()
        history = np.concatenate([history, own])
        seen = np.concatenate([seen, mass["seen"].to_numpy() / unigrams.histories()[own]])
        below = np.concatenate([below, mass["below"].to_numpy()])
    backoff, scale = _weights(unigrams, history, seen, below)
    words = counted.withColumn("bucket", _spark_bucket(F.col("word"), buckets)).repartition("bucket")
    tables = bigrams.unionByName(_built(words, _rare_table(UNIGRAM)))
    if unigrams.apart:
        # A rare history's pairs are in its bucket, others in that of their word.
        of = F.when(_of_known_history(), F.col("owner")).otherwise(F.col("history"))
        dealt = rare_pairs.withColumn("bucket", _spark_bucket(of, buckets))
        after_known = dealt.where(_of_known_history()).mapInArrow(
            _after_known(unigrams, discount, backoff, scale), "bucket INT, word BIGINT, n DOUBLE"
        )
        after_rare = _after_rare(dealt.where(~_of_known_history()), unigrams, discount)
        tables = tables.unionByName(_built(after_known.repartition("bucket"), _rare_table(LOGS)))
        tables = tables.unionByName(_built(after_rare, _table_after_rare))
    return Model(unigrams, buckets, discount, backoff, scale, tables, (hot_keys[by_key], hot_counts[by_key]))


def _built(rows: DataFrame, build) -> DataFrame:
    """A table of rows of whole buckets."""
    return rows.sortWithinPartitions("bucket").mapInArrow(build, TABLE_SCHEMA)


def _spark_bucket(word: Column, buckets: int) -> Column:
    """A word's bucket, as tasks compute it with :func:`_word_bucket`."""
    return F.pmod(F.shiftrightunsigned(word, 40), F.lit(buckets)).cast("int")


def _word_bucket(words: np.ndarray, buckets: int) -> np.ndarray:
    return ((words >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _weights(
    unigrams: Unigrams, history: np.ndarray, seen: np.ndarray, below: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Backoff weight and scale of each known history, so that its probabilities sum to one."""
    n = len(unigrams.words) + 3
    backoff, scale = np.ones(n), np.ones(n)
    at = np.unique(history)
    seen, below = (np.bincount(history, x, minlength=n)[at] for x in (seen, below))
    times = unigrams.histories()[at]
    # Nothing left to back off with: one more occurrence of the history makes room.
    factor = np.where(1 - seen < 1e-9, times / (times + 1) / seen, 1.0)
    # Everything is seen: nothing to back off to.
    full = 1 - below < 1e-12
    factor = np.where(full, 1 / seen, factor)
    scale[at] = factor
    backoff[at] = np.where(full, 0.0, (1 - factor * seen) / np.where(full, 1.0, 1 - below))
    return backoff, scale


def _occurrences(unigrams: Unigrams, buckets: int, backoff: np.ndarray, hot: tuple[np.ndarray, np.ndarray]):
    """Per document the parts of its score that need no table, and what the tables are asked."""
    together = _together(buckets)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = np.log10(unigrams.probabilities())
        with np.errstate(divide="ignore"):
            backoff_logs = np.log10(backoff)
        held: list[Asked] = []
        for flush in _flushes(batches, coded=True):
            for part in _split_docs(flush):
                held.append(_asked(part, unigrams, logs, backoff_logs, hot))
                if len(held) == together:
                    yield from _batched(_deal_rows(held, buckets), _DEAL_TYPES)
                    held = []
        if held:
            yield from _batched(_deal_rows(held, buckets), _DEAL_TYPES)

    return deal


def _split_docs(flush: Flush) -> Iterator[Flush]:
    """So few documents at once that a pair and its document fit 64 bits, and what is dealt together has at most 2^24."""
    step = (1 << _DOCS) // MOST_TOGETHER
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(flush.counts)])
    for a in range(0, len(flush.counts), step):
        z = min(a + step, len(flush.counts))
        yield Flush(flush.hashes[ends[a] : ends[z]], flush.counts[a:z], flush.codes[a:z], flush.doc_ids[a:z], flush.held_out[a:z])


# Flushes dealt together are one, known by a digest of its documents. Its rows ask a bucket for counts
# of keys (and say which of its documents has each), or tell the documents' own
# numbers; what a bucket answers is numbers of documents again.
_FLUSH = "f0 BIGINT, f1 BIGINT, size INT"
_OWN = "doc_ids ARRAY<BIGINT>, held_out ARRAY<BOOLEAN>, n_tokens ARRAY<BIGINT>"
_DEAL_SCHEMA = f"space INT, bucket INT, kind INT, {_FLUSH}, keys BINARY, counts BINARY, docs BINARY, {_OWN}, known BINARY, base BINARY, score BINARY"
_PART_SCHEMA = f"{_FLUSH}, {_OWN}, docs BINARY, known BINARY, base BINARY, score BINARY"


_DEAL_TYPES = [
    ("space", pa.int32()), ("bucket", pa.int32()), ("kind", pa.int32()), ("f0", pa.int64()), ("f1", pa.int64()),
    ("size", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("docs", pa.binary()),
    ("doc_ids", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("n_tokens", pa.list_(pa.int64())),
    ("known", pa.binary()), ("base", pa.binary()), ("score", pa.binary()),
]


def _flush_code(codes: np.ndarray, doc_ids: list) -> tuple[int, int]:
    ids = np.array([-1 if i is None else i for i in doc_ids], np.int64).view(np.uint64)
    place = np.arange(len(ids), dtype=np.uint64)
    coded = mix(codes[:, 0] + mix(codes[:, 1] + mix(ids + mix(place + np.uint64(1)))))
    first = mix(np.array([coded.sum(dtype=np.uint64)]))
    second = mix(np.array([mix(coded + np.uint64(7)).sum(dtype=np.uint64)]))
    return int(first.view(np.int64)[0]), int(second.view(np.int64)[0])


@dataclass
class Asked:
    """What the tables are asked for a flush, and its documents with what needs no table."""

    # By space: distinct (key, document), sorted by key, with how often; for logs also what deals the key.
    asks: dict[int, tuple[np.ndarray, ...]]
    codes: np.ndarray
    doc_ids: list
    held_out: list
    n_tokens: np.ndarray
    known: np.ndarray
    base: np.ndarray
    score: np.ndarray


def _asked(
    flush: Flush,
    unigrams: Unigrams,
    logs: np.ndarray,
    backoff_logs: np.ndarray,
    hot: tuple[np.ndarray, np.ndarray],
) -> Asked:
    history, word, owner, ids, rows = _pairs(flush, unigrams)
    both = _known(history, word)
    rare_history, rare_word, rare_owner = history[~both], word[~both], owner[~both]
    pairs, owner, times = _known_pairs(_pair(history[both], word[both]), owner[both])
    hot_pairs, hot_logs = hot
    whole = np.zeros(len(flush.counts))
    if len(hot_pairs):
        at = np.minimum(np.searchsorted(hot_pairs, pairs), len(hot_pairs) - 1)
        answered = hot_pairs[at] == pairs
        whole += np.bincount(owner[answered], times[answered] * hot_logs[at[answered]], minlength=len(whole))
        pairs, owner, times = pairs[~answered], owner[~answered], times[~answered]
    docs = len(flush.counts)
    # Known words beside rare ones give their part here.
    for words, of_words in ((rare_history, backoff_logs), (rare_word, logs)):
        at = words < _RARE
        whole += np.bincount(rare_owner[at], of_words[words[at].astype(np.int64)], minlength=docs)
    frequent = ids < unigrams.unknown
    known = np.bincount(rows[frequent], minlength=docs) + (unigrams.documents > 0)
    base = np.bincount(rows[frequent], logs[ids[frequent]], minlength=docs) + logs[unigrams.end]
    apart = rare_history >= _RARE
    keys = _rare_pair(rare_history, _owner(rare_history, rare_word))
    dealt_by = np.concatenate([np.where(apart, rare_history, rare_word), rare_history[apart]])
    of_logs, at = _distinct(
        np.concatenate([keys, rare_history[apart]]), np.concatenate([rare_owner, rare_owner[apart]])
    )
    of_words, _ = _distinct(flush.hashes[~frequent], rows[~frequent])
    asks = {
        BIGRAM: (pairs, owner.astype(np.int32), times.astype(np.int32)),
        LOGS: (*of_logs, dealt_by[at]),
        UNIGRAM: of_words,
    }
    n_tokens = flush.counts.astype(np.int64) + 1
    return Asked(asks, flush.codes, flush.doc_ids, flush.held_out, n_tokens, known, base, whole)


def _deal_rows(held: list[Asked], buckets: int) -> Iterator[dict]:
    """The rows of flushes dealt together."""
    doc_ids, held_out = [x for a in held for x in a.doc_ids], [x for a in held for x in a.held_out]
    f0, f1 = _flush_code(np.concatenate([a.codes for a in held]), doc_ids)
    flush = {"kind": 1, "f0": f0, "f1": f1, "size": len(doc_ids)}
    firsts = np.cumsum([0, *(len(a.doc_ids) for a in held)])
    for space in (BIGRAM, LOGS, UNIGRAM):
        asks = [a.asks.pop(space) for a in held]
        sizes = [len(x[0]) for x in asks]
        keys, of, times, *dealt_by = (np.concatenate(x) for x in zip(*asks))
        del asks
        if len(held) > 1:
            of += np.repeat(firsts[:-1], sizes).astype(np.int32)
            order = np.argsort(keys, kind="stable")
            keys, of, times, *dealt_by = (x[order] for x in (keys, of, times, *dealt_by))
            del order
        bucket = _bucket(keys, buckets) if space == BIGRAM else _word_bucket(*dealt_by or [keys], buckets)
        for b, at in _dealt(bucket, buckets):
            for part in _parts(len(at)):
                own = at[part]
                packed = {"keys": _pack(keys[own]), "counts": _pack_small(times[own]), "docs": _pack_small(of[own])}
                yield {"space": space, "bucket": b, **packed, **flush}
    n_tokens, known, base, score = (
        np.concatenate([getattr(a, x) for a in held]) for x in ("n_tokens", "known", "base", "score")
    )
    # Any bucket will do for what asks nothing.
    yield {
        "space": -1, "bucket": f0 % buckets, "doc_ids": doc_ids, "held_out": held_out, "n_tokens": n_tokens,
        "known": known.astype("<i8").tobytes(), "base": base.astype("<f8").tobytes(),
        "score": score.astype("<f8").tobytes(), **flush,
    }


def _known_pairs(pairs: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (pair of known words, document), sorted, with how often."""
    both = np.sort((pairs << np.uint64(_DOCS)) | of.astype(np.uint64))
    at = np.flatnonzero(np.diff(both, prepend=~both[:1]))
    times = np.diff(at, append=len(both))
    both = both[at]
    return both >> np.uint64(_DOCS), (both & np.uint64((1 << _DOCS) - 1)).astype(np.int64), times


def _distinct(keys: np.ndarray, of: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """Distinct (key, document), sorted by key, with how often; where each comes first.

    The documents of a key must be in their order.
    """
    order = np.argsort(keys, kind="stable")
    keys, of = keys[order], of[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    times = np.diff(at, append=len(keys))
    return (keys[at], of[at].astype(np.int32), times.astype(np.int32)), order[at]


def _scorer(model_parts: tuple):
    unigrams, discount, backoff, scale = model_parts

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower, times = unigrams.probabilities(), unigrams.histories()
        lower_logs = np.log10(lower)
        with np.errstate(divide="ignore"):
            backoff_logs = np.log10(backoff)
        held, known_rows, table, table_counts = None, [], np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            names = (batch.column(x).to_pylist() for x in ("space", "bucket", "kind"))
            cells = (_cells(batch, x) for x in ("keys", "counts", "docs"))
            own, numbers = [], []
            for i, (space, bucket, kind, keys, counts, docs) in enumerate(zip(*names, *cells)):
                if (space, bucket) != held:
                    held, known_rows = (space, bucket), []
                    table, table_counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
                if kind == 0:
                    values = np.frombuffer(counts, "<f8") if space == LOGS else _unpack_small(counts)
                    known_rows.append((_unpack(keys), values))
                    continue
                if known_rows:
                    # The rows of a bucket's table come first, in any order.
                    table, table_counts = (np.concatenate(x) for x in zip(*known_rows))
                    order, known_rows = np.argsort(table), []
                    table, table_counts = table[order], table_counts[order]
                own.append(i)
                if space < 0:
                    numbers.append((None, *(batch.column(x)[i].as_py() for x in ("known", "base", "score"))))
                else:
                    asked, n = _unpack(keys), _unpack_small(counts)
                    # Only documents that ask are answered.
                    present, of = _present(_unpack_small(docs))
                    found = np.zeros(len(asked), table_counts.dtype)
                    if len(table):
                        at = np.minimum(np.searchsorted(table, asked), len(table) - 1)
                        found = np.where(table[at] == asked, table_counts[at], 0)
                    known = base = None
                    if space == BIGRAM:
                        history, word = _split(asked)
                        seen = _seen_logs(asked, found, discount, scale, times)
                        logs = np.where(found > 0, seen, backoff_logs[history] + lower_logs[word])
                    elif space == LOGS:
                        logs = found
                    else:
                        of_word = np.log10((found + 1) / unigrams.total)
                        logs = of_word if unigrams.apart else of_word - lower_logs[unigrams.unknown]
                        known = np.bincount(of, n * (found > 0)).astype("<i8").tobytes()
                        base = np.bincount(of, n * of_word).astype("<f8").tobytes()
                    whole = np.bincount(of, n * logs).astype("<f8").tobytes()
                    numbers.append((_pack_small(present), known, base, whole))
            if own:
                flushes = batch.select(["f0", "f1", "size", "doc_ids", "held_out", "n_tokens"]).take(pa.array(own))
                yield pa.RecordBatch.from_arrays(
                    [*flushes.columns, *(pa.array(x, pa.binary()) for x in zip(*numbers))],
                    [*flushes.schema.names, "docs", "known", "base", "score"],
                )

    return score


def _present(docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct documents in their order, and the place of each of ``docs`` in them."""
    most = int(docs.max()) + 1
    if most > 8 * len(docs):
        return np.unique(docs, return_inverse=True)
    there = np.zeros(most, bool)
    there[docs] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[docs]


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document from the rows of whole flushes, sorted by flush.

    Flushes of equal documents have one digest; their numbers add up, so each of
    them has its share.
    """
    held, numbers, own, copies = None, [], None, 0

    def rows() -> pa.RecordBatch:
        known, base, whole = (x / copies for x in numbers)
        one = pa.RecordBatch.from_arrays(
            [
                own[0], own[1], own[2], pa.array(np.rint(known).astype(np.int64)), pa.array(base), pa.array(whole),
            ],
            ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
        )
        return one if copies == 1 else pa.Table.from_batches([one] * copies).combine_chunks().to_batches()[0]

    for batch in batches:
        names = (batch.column(x).to_pylist() for x in ("f0", "f1", "size"))
        cells = (_cells(batch, x) for x in ("docs", "known", "base", "score"))
        for i, (f0, f1, size, docs, known, base, whole) in enumerate(zip(*names, *cells)):
            if (f0, f1) != held:
                if held is not None and copies:
                    yield rows()
                held, numbers, own, copies = (f0, f1), [np.zeros(size) for _ in range(3)], None, 0
            if docs is None:
                copies += 1
                own = [batch.column(x)[i].values for x in ("doc_ids", "held_out", "n_tokens")]
                at = slice(None)
            else:
                at = _unpack_small(docs)
            for total, data, kind in zip(numbers, (known, base, whole), ("<i8", "<f8", "<f8")):
                if data is not None:
                    total[at] += np.frombuffer(data, kind)
    if held is not None and copies:
        yield rows()


def score(rows: DataFrame, model: Model) -> DataFrame:
    """Scores of the rows (doc_id, text, held_out): one row for each, repeated ones too.

    Each row's log10 probability by the unigram model and by the whole one, of
    all words of its text (a null text has none) and one end.
    """
    unigrams = model.unigrams
    hot = model.hot[0], model.seen(*model.hot)
    asked = rows.mapInArrow(_occurrences(unigrams, model.buckets, model.backoff, hot), _DEAL_SCHEMA)
    known = model.tables.select("space", "bucket", F.lit(0).alias("kind"), "keys", "counts")
    parts = (
        known.unionByName(asked, allowMissingColumns=True)
        .repartition("space", "bucket")
        .sortWithinPartitions("space", "bucket", "kind")
        .mapInArrow(_scorer((unigrams, model.discount, model.backoff, model.scale)), _PART_SCHEMA)
    )
    scored = parts.repartition("f0", "f1").sortWithinPartitions("f0", "f1").mapInArrow(_gather, RESULT_SCHEMA)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(unigrams.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
    )


def score_documents(split: DataFrame, vocabulary: int | None = VOCABULARY) -> DataFrame:
    """Learn from the rows that are not held out, and score all of them."""
    rows = split.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "held_out")
    return score(rows, train(rows.where("NOT held_out"), vocabulary))
