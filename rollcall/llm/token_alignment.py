"""Alignment of the tokens of two vocabularies over the same text.

Both write a text as tokens whose bytes, one after the other, are the text's. A
dictionary from the byte where each token ends to its place is made for either
side; the ends that both dictionaries have, sorted, cut the two lists of ids into
groups. Within a group a token of one side is linked to the tokens of the other
whose bytes it shares.

Neither vocabulary has a token with a space after a visible character, so a text
falls apart, for both, before a space that follows a visible character. Such
chunks are aligned once per task, many joined to one text; what a document has
is put together from its chunks. A vocabulary without this property is found
when it is loaded, and then a whole text is one chunk.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import Memo, SpanHash, bytes_of, ship_code, slices, stored
from .tokenizer_files import byte_encoding, library

# Bytes of chunks aligned as one text, and of kept chunks after which a task starts anew.
JOINED_BYTES = 1 << 16
KEPT_BYTES = 48 << 20
# Pairs of ids counted in a task before they are passed on, and pairs in one broadcast.
COUNTED_PAIRS = 1 << 22
BLOCK_PAIRS = 1 << 22
SEPARATORS = np.frombuffer(b",|;", np.uint8)


def default_paths() -> tuple[str, str]:
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _digits(n: int) -> np.ndarray:
    """Decimal digits of 0 to n - 1 as bytes, one row each, 0 after the last digit."""
    text = np.arange(n).astype("S")
    return np.frombuffer(text.tobytes(), np.uint8).reshape(n, -1)


class Pair:
    """The two vocabularies: ids and bytes of a text's tokens in either."""

    def __init__(self, path_a: str, path_b: str):
        self.path_a = path_a
        self.a = byte_encoding(path_a)
        size_a = self.a.n_vocab
        self.bytes_a = [b""] * size_a
        special = {self.a.encode_single_token(s) for s in self.a.special_tokens_set}
        for i in range(size_a):
            if i not in special:
                self.bytes_a[i] = self.a.decode_single_token_bytes(i)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.size_b = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.sizes_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.digits = _digits(max(size_a, self.size_b))
        self.codes = np.uint32 if size_a * self.size_b < 1 << 32 else np.uint64
        inner = re.compile(rb"[!-~] |\xc3[\x80-\xbf] ")
        self.apart = not any(inner.search(x) for x in (*self.bytes_a, *self.bytes_b))

    def ids_a(self, raw: str) -> list[int]:
        try:
            return self.a.encode(raw, allowed_special=set(), disallowed_special=())
        except ValueError:
            # The splitting pattern gives up on a million white-space characters in a row.
            whole = library(self.path_a)
            whole.encode_special_tokens = True
            try:
                return whole.encode(raw, add_special_tokens=False).ids
            finally:
                whole.encode_special_tokens = False

    def ids_b(self, raw: str) -> list[int]:
        """Ids of ``raw`` without its first character, the space that the vocabulary adds."""
        # No space is added to an empty text.
        return self.b.encode(raw[1:]) if len(raw) > 1 else [self.b.piece_to_id("▁")]


@lru_cache(maxsize=2)
def vocabularies(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


class Alignment:
    """Groups and links of one text that begins with a space.

    ``ids_a``, ``ids_b``; ``cuts_a``, ``cuts_b``: where each group begins in them
    (and the last ends); ``ends``: the byte where each group ends; ``link_a``,
    ``link_b``: linked places. All are empty if a side does not give the text's
    bytes back.
    """

    def __init__(self, pair: Pair, raw: str):
        ids_a, ids_b = pair.ids_a(raw), pair.ids_b(raw)
        data = raw.encode()
        self.whole = (
            b"".join(map(pair.bytes_a.__getitem__, ids_a)) == data
            and b"".join(map(pair.bytes_b.__getitem__, ids_b)) == data
        )
        if not self.whole:
            ids_a, ids_b = [], []
        self.ids_a, self.ids_b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        ends_a, ends_b = np.cumsum(pair.sizes_a[self.ids_a]), np.cumsum(pair.sizes_b[self.ids_b])
        after_a = dict(zip(ends_a.tolist(), range(1, len(ids_a) + 1)))
        after_b = dict(zip(ends_b.tolist(), range(1, len(ids_b) + 1)))
        common = sorted(after_a.keys() & after_b.keys())
        self.ends = np.array(common, np.int64)
        self.cuts_a = np.array([0, *map(after_a.__getitem__, common)], np.int64)
        self.cuts_b = np.array([0, *map(after_b.__getitem__, common)], np.int64)
        self._link(ends_a, ends_b, pair)

    def _link(self, ends_a: np.ndarray, ends_b: np.ndarray, pair: Pair) -> None:
        """Expand each slice: tokens of A to the run of B's tokens that they share bytes with."""
        sizes = np.diff(self.cuts_a)
        slice_of = np.repeat(np.arange(len(sizes)), sizes)
        # A slice of one token on either side is linked throughout.
        first, last = self.cuts_b[slice_of], self.cuts_b[slice_of + 1] - 1
        both = np.flatnonzero((sizes > 1) & (np.diff(self.cuts_b) > 1))
        inner = np.flatnonzero(np.isin(slice_of, both))
        if len(inner):
            starts = ends_a[inner] - pair.sizes_a[self.ids_a[inner]]
            first[inner] = np.searchsorted(ends_b, starts, "right")
            last[inner] = np.searchsorted(ends_b, ends_a[inner], "left")
        n = last - first + 1
        self.link_a = np.repeat(np.arange(len(n)), n)
        self.link_b = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(len(self.link_a))

    def text(self, pair: Pair) -> tuple[np.ndarray, np.ndarray]:
        """All groups as ``a1,a2|b1;...``, and where each group's text begins (and the last ends)."""
        n_a, n_b = len(self.ids_a), len(self.ids_b)
        width = pair.digits.shape[1] + 1
        out = np.zeros((n_a + n_b, width), np.uint8)
        sizes_a, sizes_b = np.diff(self.cuts_a), np.diff(self.cuts_b)
        at_a = np.arange(n_a) + np.repeat(self.cuts_b[:-1], sizes_a)
        at_b = np.arange(n_b) + np.repeat(self.cuts_a[1:], sizes_b)
        out[at_a, :-1], out[at_b, :-1] = pair.digits[self.ids_a], pair.digits[self.ids_b]
        out[:, -1] = SEPARATORS[0]
        out[at_a[self.cuts_a[1:] - 1], -1] = SEPARATORS[1]
        out[at_b[self.cuts_b[1:] - 1], -1] = SEPARATORS[2]
        lengths = np.concatenate([np.zeros(1, np.int64), np.cumsum((out > 0).sum(1))])
        return out[out > 0], lengths[self.cuts_a + self.cuts_b]


class Chunks:
    """Aligned chunks by hash: counts, coded links and the text of the groups of each."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.memo = Memo(1 << 62)
        self.kept = 0
        self.texts: list[bytes] = []
        # Per chunk: whether both sides give its bytes, tokens, tokens, groups, links.
        self.counts = np.zeros((0, 5), np.int64)
        self.links = np.zeros(0, pair.codes)
        self.begins = np.zeros(1, np.int64)

    def places(self, hashes: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray, closed: np.ndarray) -> np.ndarray:
        """The place of each span's chunk; those not seen yet are aligned."""
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)

        def compute(missing: np.ndarray) -> np.ndarray:
            at = first[missing]
            places = np.zeros(len(at), np.int64)
            # Closed chunks end where the next may begin: they are joined to one text.
            joined, size = [], 0
            for i, (a, b, ok) in enumerate(zip(starts[at].tolist(), ends[at].tolist(), closed[at].tolist())):
                if ok and b - a < JOINED_BYTES:
                    joined.append((i, data[a:b]))
                    size += b - a
                    if size >= JOINED_BYTES:
                        self._add(joined, places)
                        joined, size = [], 0
                else:
                    self._add([(i, data[a:b])], places)
            self._add(joined, places)
            return places

        return self.memo.get(keys, compute)[inverse]

    def _add(self, joined: list[tuple[int, bytes]], places: np.ndarray) -> None:
        if not joined:
            return
        found = Alignment(self.pair, b"".join(x for _, x in joined).decode())
        if not found.whole and len(joined) > 1:
            # One of them does not come back: each is taken by itself.
            for one in joined:
                self._add([one], places)
            return
        index = np.array([i for i, _ in joined])
        places[index] = len(self.texts) + np.arange(len(joined))
        counts = np.zeros((len(joined), 5), np.int64)
        counts[:, 0] = found.whole
        codes = np.zeros(0, self.pair.codes)
        if found.whole:
            # Every chunk ends where a group ends, so groups count off its tokens.
            group = np.searchsorted(found.ends, np.cumsum([len(x) for _, x in joined])) + 1
            bounds = np.concatenate([np.zeros(1, np.int64), group])
            links = np.searchsorted(found.link_a, found.cuts_a[bounds])
            for column, ends in ((1, found.cuts_a[bounds]), (2, found.cuts_b[bounds]), (3, bounds), (4, links)):
                counts[:, column] = np.diff(ends)
            codes = found.ids_a[found.link_a] * self.pair.size_b + found.ids_b[found.link_b]
            text, begins = found.text(self.pair)
            text = text.tobytes()
            spans = begins[bounds].tolist()
            self.texts += [text[a : b - 1] for a, b in zip(spans[:-1], spans[1:])]
        else:
            self.texts.append(b"")
        self.counts = np.concatenate([self.counts, counts])
        self.links = np.concatenate([self.links, codes.astype(self.pair.codes)])
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(counts[:, 4])])
        self.kept += sum(len(x) for _, x in joined) * 8


def _cut(column: pa.Array, pair: Pair):
    """Bytes of space + text of each row, and its chunks: starts, ends, closed, rows' bounds."""
    data, offsets = bytes_of(column)
    rows = len(offsets) - 1
    raw = np.full(len(data) + rows, 0x20, np.uint8)
    raw[np.arange(len(data)) + np.repeat(np.arange(1, rows + 1), np.diff(offsets))] = data
    offsets = offsets + np.arange(rows + 1)
    visible = (raw > 0x20) & (raw < 0x7F)
    # Latin letters of two bytes count as visible; other characters may be white space.
    visible[1:] |= (raw[1:] >= 0x80) & (raw[1:] < 0xC0) & (raw[:-1] == 0xC3)
    begin = np.zeros(len(raw), bool)
    if pair.apart:
        begin[1:] = visible[:-1] & (raw[1:] == 0x20)
    begin[offsets[:-1]] = True
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], len(raw))
    bounds = np.searchsorted(starts, offsets)
    return raw, starts, ends, visible[ends - 1] & pair.apart, bounds


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sum of ``n`` of each."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


def _aligner(paths: tuple[str, str], id_column: str):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = vocabularies(*paths)
        chunks = Chunks(pair)
        for batch in slices(batches):
            raw, starts, ends, closed, bounds = _cut(batch.column("text"), pair)
            place = chunks.places(SpanHash.of_bytes(raw).spans(starts, ends), raw.tobytes(), starts, ends, closed)
            per_row = np.add.reduceat(chunks.counts[place], bounds[:-1], axis=0)
            n_chunks = np.diff(bounds)
            filled = (per_row[:, 0] == n_chunks) & (ends[bounds[1:] - 1] - starts[bounds[:-1]] > 1)
            per_row[~filled] = 0
            # Coded links of the rows' chunks, summed to one count per row and pair.
            row = np.repeat(np.arange(batch.num_rows), n_chunks)
            used = filled[row]
            row, taken = row[used], place[used]
            n = chunks.counts[taken, 4]
            at = np.repeat(chunks.begins[taken] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            codes = chunks.links[at]
            keys = np.repeat(row, n).astype(np.uint64)
            order = np.lexsort((codes, keys)) if pair.codes is np.uint64 else np.argsort(
                (keys << np.uint64(32)) | codes, kind="stable"
            )
            keys, codes = keys[order], codes[order]
            change = np.ones(len(codes), bool)
            change[1:] = (codes[1:] != codes[:-1]) | (keys[1:] != keys[:-1])
            first = np.flatnonzero(change)
            times = np.diff(np.append(first, len(codes))).astype(np.uint32)
            keys, codes = keys[first], codes[first]
            cuts = np.searchsorted(keys, np.arange(batch.num_rows + 1).astype(np.uint64)).tolist()
            digests, names = [], place.tolist()
            limits = bounds.tolist()
            for i, ok in enumerate(filled.tolist()):
                text = b";".join(map(chunks.texts.__getitem__, names[limits[i] : limits[i + 1]])) if ok else b""
                digests.append(hashlib.sha256(text).hexdigest() if ok else "")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_column),
                    *(pa.array(per_row[:, i]) for i in range(1, 5)),
                    pa.array(digests, pa.string()),
                    pa.array([codes[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                    pa.array([times[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                ],
                [id_column, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
            )
            if chunks.kept + chunks.links.nbytes > KEPT_BYTES:
                chunks = Chunks(pair)

    return align


def align_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per row: doc_id, sizes, digest of the groups, and its linked pairs of ids with their counts.

    ``pairs`` has codes (id of A times the size of B, plus id of B) and ``times``
    how many links of the row have each, as arrays of bytes. A text that is null
    or empty, or that a side does not give back byte for byte, has no tokens.
    """
    ship_code(docs.sparkSession)
    default_a, default_b = default_paths()
    paths = (path_a or default_a, path_b or default_b)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _aligner(paths, "doc_id"),
        f"doc_id {id_type}, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT, groups_sha256 STRING, "
        "pairs BINARY, times BINARY",
    )


def _counter(codes):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        sizes, waiting = [], 0
        keys, n = np.zeros(0, codes), np.zeros(0, np.int64)

        def batch_of(keys, n):
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], ["pair", "n"])

        for batch in batches:
            for part in slices([batch], "pairs"):
                found, _ = bytes_of(part.column("pairs"))
                times, _ = bytes_of(part.column("times"))
                held.append(found.tobytes())
                sizes.append(times.tobytes())
                waiting += len(found)
                if waiting < COUNTED_PAIRS:
                    continue
                keys, n = _merged(keys, n, held, sizes, codes)
                held, sizes, waiting = [], [], 0
                if len(keys) > COUNTED_PAIRS:
                    yield batch_of(keys, n)
                    keys, n = keys[:0], n[:0]
        keys, n = _merged(keys, n, held, sizes, codes)
        for at in range(0, len(keys), 1 << 16):
            yield batch_of(keys[at : at + (1 << 16)], n[at : at + (1 << 16)])

    return count


def _merged(keys, n, held, sizes, codes):
    more = np.frombuffer(b"".join(held), codes)
    times = np.frombuffer(b"".join(sizes), np.uint32).astype(np.int64)
    return _summed(np.concatenate([keys, more]), np.concatenate([n, times]))


def pair_counts(aligned: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """pair, id_a, id_b, n (links of all rows that have it) and best (whether it is its B id's highest n).

    One row for each linked pair of ids: at most the product of the vocabularies.
    """
    default_a, default_b = default_paths()
    pair = vocabularies(path_a or default_a, path_b or default_b)
    counted = aligned.select("pairs", "times").mapInArrow(_counter(pair.codes), "pair BIGINT, n BIGINT")
    counts = stored(
        counted.groupBy("pair").agg(F.sum("n").alias("n")).select(
            "pair",
            F.expr(f"pair div {pair.size_b}").alias("id_a"),
            (F.col("pair") % pair.size_b).alias("id_b"),
            "n",
        ),
        "pairs",
    )
    highest = counts.groupBy("id_b").agg(F.max("n").alias("highest"))
    return counts.join(highest, "id_b").select("pair", "id_a", "id_b", "n", (F.col("n") == F.col("highest")).alias("best"))


def _adder(shared, codes):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            for rows in slices([batch], "pairs"):
                found, offsets = bytes_of(rows.column("pairs"))
                found = np.frombuffer(found.tobytes(), codes)
                times = np.frombuffer(bytes_of(rows.column("times"))[0].tobytes(), np.uint32).astype(np.int64)
                at = np.minimum(np.searchsorted(known, found), max(len(known) - 1, 0))
                here = known[at] == found if len(known) else np.zeros(len(found), bool)
                sums = np.zeros((len(found) + 1, 2), np.int64)
                if len(known):
                    sums[1:, 0] = np.cumsum(np.where(here & best[at], times, 0))
                    sums[1:, 1] = np.cumsum(np.where(here, times * n[at], 0))
                bounds = offsets // np.dtype(codes).itemsize
                more = sums[bounds[1:]] - sums[bounds[:-1]]
                names = rows.schema.names
                columns = [rows.column(c) for c in names]
                for i, name in enumerate(("n_best", "count_sum")):
                    place = names.index(name)
                    columns[place] = pa.array(columns[place].to_numpy(zero_copy_only=False) + more[:, i])
                yield pa.RecordBatch.from_arrays(columns, names)

    return add


def score_links(aligned: DataFrame, counts: DataFrame, codes=np.uint32, block: int = BLOCK_PAIRS) -> DataFrame:
    """``aligned`` with n_best and count_sum of each row's links.

    The counts are measured first and go to the tasks in blocks of about ``block``
    pairs, one pass over the rows each; so what is sent never exceeds a block
    however many pairs there are.
    """
    spark = aligned.sparkSession
    blocks = max(1, -(-counts.count() // block))
    rows = aligned.withColumn("n_best", F.lit(0).cast("bigint")).withColumn("count_sum", F.lit(0).cast("bigint"))
    for i in range(blocks):
        if i:
            rows = stored(rows, "scored-links")
        part = counts.where(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == i).select("pair", "n", "best").toArrow()
        known = part.column("pair").to_numpy().astype(codes)
        order = np.argsort(known)
        shared = spark.sparkContext.broadcast(
            (known[order], part.column("n").to_numpy()[order], part.column("best").to_numpy()[order])
        )
        rows = rows.mapInArrow(_adder(shared, codes), rows.schema)
    return rows


def align_and_score(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    A link's count is how many links of all rows have its pair of ids; it is best
    if no other pair of its B id has more. Rows without tokens (null or empty
    text, or text that a side does not give back) have zeros and an empty
    ``groups_sha256``. Repeated rows and ids stay and count each; an empty table
    gives no rows; columns other than doc_id and text are not read.
    """
    default_a, default_b = default_paths()
    paths = (path_a or default_a, path_b or default_b)
    aligned = stored(align_documents(docs, *paths), "aligned")
    counts = stored(pair_counts(aligned, *paths), "pair-counts")
    scored = score_links(aligned, counts, vocabularies(*paths).codes)
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
