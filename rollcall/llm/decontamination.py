"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are compared without white space and without the case of A to Z. Every
place of a document whose next ``Q`` bytes also occur in a benchmark item is a
hit on the diagonal (place in the document - place in the item). Hits are
counted in overlapping bands of diagonals. An alignment of n bytes with at most
k edits has at least n + 1 - Q - k * Q hits and drifts by at most k diagonals,
so a band with fewer cannot hold it. What remains is aligned from its hits on to
both ends, as far as the edits go. Items too short for the lemma are looked for
by pieces of which one must occur unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import LOWER, SPACE, SpanHash, bytes_of, slices

Q = 10
# Edits per byte of the benchmark text.
EDITS = 0.06
# A leak covers at least this share of an item, and at least so many bytes (or
# the whole item, if that is shorter).
COVER = 0.5
LEAST_BYTES = 40
# Cells of the tables of one round of alignments.
CELLS = 1 << 20
# Repetition of a text within so many bytes is told from other text.
PERIODS = 16
# Benchmark text that one pass broadcasts; a larger benchmark takes several passes.
BLOCK_BYTES = 16 << 20
_BITS = 22


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes without white space, A to Z in lower case, and the offsets of the rows."""
    keep = ~SPACE[data]
    before = np.concatenate([np.zeros(1, np.int64), np.cumsum(keep)])
    return LOWER[data[keep]], before[offsets]


def _codes(data: np.ndarray) -> np.ndarray:
    """Each run of ``Q`` bytes as a number: eight of them, mixed with the other two."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    eight = np.ndarray((n,), "<u8", buffer=np.ascontiguousarray(data), strides=(1,))
    two = data[8 : 8 + n].astype(np.uint64) | (data[9 : 9 + n].astype(np.uint64) << np.uint64(8))
    return (eight ^ (two * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)


class Index:
    """Places of all q-grams of the benchmark items."""

    def __init__(self, item_ids: list[int], texts: list[str]):
        data, offsets = bytes_of(pa.array(texts, pa.string()))
        self.data, self.offsets = normalised(data, offsets)
        self.item_ids = np.array(item_ids, np.int64)
        self.lengths = np.diff(self.offsets)
        codes = _codes(self.data)
        places = np.arange(len(codes))
        items = np.searchsorted(self.offsets, places, "right") - 1
        inside = places + Q <= self.offsets[items + 1] if len(codes) else np.zeros(0, bool)
        codes, places, items = codes[inside], places[inside], items[inside]
        order = np.argsort(codes, kind="stable")
        self.codes, first = np.unique(codes[order], return_index=True)
        self.first = np.append(first, len(order))
        self.items = items[order]
        self.places = places[order] - self.offsets[self.items]
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[self.codes >> np.uint64(64 - _BITS)] = True
        self.edits = math.floor(EDITS * int(self.lengths.max(initial=0)))
        self.band = 2 * (self.edits + 1)
        # No leak takes more bytes of a text than this, its place in a repetition included.
        self.reach = int(self.lengths.max(initial=0)) + self.edits + 2 * Q + PERIODS
        self.least = np.array([least_hits(int(n)) for n in self.lengths], np.int64)
        # An edit spoils Q q-grams and may add a byte: hits further apart are of different regions.
        self.gaps = (Q + 1) * np.floor(EDITS * self.lengths).astype(np.int64) + 1
        self.pieces = self._pieces()

    def _pieces(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By length: hashes, items and places of the pieces of items too short for the lemma.

        One piece more than edits, so one of them is unchanged in every leak.
        """
        found: dict[int, list[tuple[int, int]]] = {}
        for item in np.flatnonzero((self.least <= 0) & (self.lengths > 0)):
            n = int(self.lengths[item])
            ends = np.linspace(0, n, math.floor(EDITS * n) + 2).astype(int).tolist()
            for start, end in zip(ends, ends[1:]):
                found.setdefault(end - start, []).append((int(item), start))
        out = {}
        whole = SpanHash.of_bytes(self.data) if found else None
        for size, own in found.items():
            items, places = (np.array(x, np.int64) for x in zip(*own))
            starts = self.offsets[items] + places
            hashes = whole.spans(starts, starts + size)
            order = np.argsort(hashes, kind="stable")
            out[size] = hashes[order], items[order], places[order]
        return out

    def piece_hits(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """Places in ``data`` of pieces of each length, with item and place there."""
        whole = SpanHash.of_bytes(data) if self.pieces else None
        for size, (hashes, items, places) in self.pieces.items():
            starts = np.arange(max(0, len(data) - size + 1))
            codes = whole.spans(starts, starts + size)
            first, last = np.searchsorted(hashes, codes, "left"), np.searchsorted(hashes, codes, "right")
            at = np.flatnonzero(last > first)
            sizes = last[at] - first[at]
            row = np.repeat(first[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            yield np.repeat(at, sizes), items[row], places[row], size

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of ``codes``, with item and place there; one row per pair that agrees."""
        at = np.flatnonzero(self.maybe[codes >> np.uint64(64 - _BITS)])
        found = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
        same = self.codes[found] == codes[at]
        at, found = at[same], found[same]
        sizes = self.first[found + 1] - self.first[found]
        shift = self.first[found] - (np.cumsum(sizes) - sizes)
        row = np.repeat(shift, sizes) + np.arange(sizes.sum())
        return np.repeat(at, sizes), self.items[row], self.places[row]

    def text(self, item: int) -> np.ndarray:
        return self.data[self.offsets[item] : self.offsets[item + 1]]


def needed_hits(length: int) -> int:
    """The q-gram lemma: fewest hits of an alignment of so many bytes within its edits."""
    return length + 1 - Q - math.floor(EDITS * length) * Q


def least_cover(length: int) -> int:
    return min(length, max(LEAST_BYTES, math.ceil(COVER * length)))


def least_hits(length: int) -> int:
    """The fewest hits of any leak of an item of so many bytes; 0 or less if it may have none."""
    n = np.arange(least_cover(length), length + 1)
    return int((n + 1 - Q - np.floor(EDITS * n).astype(np.int64) * Q).min(initial=length + 1 - Q))


def banded_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Edit distance of two byte arrays if it is at most ``most``, else ``most + 1``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if len(a) == len(b) and np.array_equal(a, b):
        return 0
    width = 2 * most + 1
    shift = np.arange(width)
    far = most + 1
    # Cell j of row i stands for b up to i + j - most.
    row = np.where(shift >= most, shift - most, far)
    for i in range(1, len(a) + 1):
        column = i + shift - most
        inside = (column >= 1) & (column <= len(b))
        differs = np.ones(width, np.int64)
        differs[inside] = b[column[inside] - 1] != a[i - 1]
        best = np.where(inside, row + differs, far)
        best = np.minimum(best, np.append(row[1:], far) + 1)
        best = np.where(column == 0, np.minimum(best, i), best)
        best[(column < 0) | (column > len(b))] = far
        best = np.minimum.accumulate(best - shift) + shift
        row = np.minimum(best, far)
        if row.min() >= far:
            return far
    end = len(b) - len(a) + most
    return int(min(row[end], far))


def _regions(index: Index, rows: np.ndarray, places: np.ndarray, items: np.ndarray, in_item: np.ndarray):
    """(row, item, from, to in the row, from, to in the item) of what the lemma retains."""
    diagonal = places - in_item
    half = index.band // 2
    # A diagonal lies in two bands, which overlap by half.
    bands = np.concatenate([diagonal // index.band * 2, (diagonal + half) // index.band * 2 + 1])
    both = [np.concatenate([x, x]) for x in (rows, items, places, in_item)]
    order = np.lexsort((both[2], bands, both[1], both[0]))
    r, t, p, q = (x[order] for x in both)
    b = bands[order]
    new = np.ones(len(r), bool)
    new[1:] = (np.diff(r) != 0) | (np.diff(t) != 0) | (np.diff(b) != 0) | (np.diff(p) > index.gaps[t[1:]])
    starts = np.flatnonzero(new)
    if not len(starts):
        return
    ends = np.append(starts[1:], len(r))
    # A place counts once per band, however often the item repeats the q-gram.
    fresh = new | (np.diff(p, prepend=-1) != 0)
    counts = np.add.reduceat(fresh.astype(np.int64), starts)
    least = index.least[t[starts]]
    for i in np.flatnonzero((counts >= least) & (least > 0)):
        a, z = starts[i], ends[i]
        item = int(t[a])
        yield int(r[a]), item, p[a:z], q[a:z]


def _anchors(places: np.ndarray, in_item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points that every alignment through a hit passes: each ``Q`` bytes of a run of hits.

    A run is of hits on one diagonal that touch; the points of longer runs come first.
    """
    diagonal = places - in_item
    by = np.lexsort((places, diagonal))
    p, d = places[by], diagonal[by]
    new = np.ones(len(by), bool)
    new[1:] = (np.diff(d) != 0) | (np.diff(p) > Q)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(by)) - 1
    sizes = p[ends] + Q - p[starts]
    points = [(p[s] + np.arange(0, n, Q), n, d[s]) for s, n in zip(starts, sizes)]
    points.sort(key=lambda x: -x[1])
    at = np.concatenate([x[0] for x in points])
    return at, at - np.repeat([x[2] for x in points], [len(x[0]) for x in points])


def _reach(own: np.ndarray, text: np.ndarray, q: np.ndarray, d: np.ndarray, most: int):
    """Fewest edits of the next m bytes of ``own`` from ``q`` on against ``text`` from ``d`` on.

    Per m (rows) and anchor (columns), with the bytes of the text that takes; the
    end in the text is free. More than ``most`` edits count as ``most + 1``.
    """
    far, width, longest = most + 1, 2 * most + 1, int((len(own) - q).max(initial=0))
    shift = np.arange(width)
    edits = np.full((longest + 1, len(q)), far, np.int32)
    taken = np.zeros((longest + 1, len(q)), np.int64)
    # Beyond the text nothing agrees, and a change there is as dear as a byte left out.
    room = np.full(longest + 2 * most + 1, 256, np.int16)
    padded = np.concatenate([np.full(most + 1, 256, np.int16), text.astype(np.int16), room])
    mine = np.concatenate([own.astype(np.int16), np.full(longest + 1, 257, np.int16)])
    row = np.tile(np.where(shift >= most, shift - most, far).astype(np.int32), (len(q), 1))
    last = np.full((len(q), 1), far, np.int32)
    columns = np.arange(len(q))
    near = d[:, None] + shift
    for m in range(longest + 1):
        if m:
            # Cell j of row m stands for m + j - most bytes of the text; before its anchor there are none.
            best = row + (padded[near + m] != mine[q + m - 1][:, None])
            np.minimum(best, np.concatenate([row[:, 1:], last], axis=1) + 1, out=best)
            if m <= most:
                best[:, : most - m] = far
                best[:, most - m] = m
            row = np.minimum(np.minimum.accumulate(best - shift, axis=1) + shift, far).astype(np.int32)
        at = row.argmin(axis=1)
        edits[m] = np.where(q + m <= len(own), row[columns, at], far)
        taken[m] = np.clip(m + at - most, 0, len(text) - d)
        if edits[m].min() >= far:
            break
    return edits, taken


def _best_region(index: Index, text: np.ndarray, item: int, places: np.ndarray, in_item: np.ndarray):
    """The longest stretch through one of the points that aligns within its edits.

    As (from, to, from, to, edits). Each point is extended to the right and to the
    left; of all ways to share the edits the one that takes most of the item counts.
    """
    own = index.text(item)
    least, most = least_cover(len(own)), math.floor(EDITS * len(own))
    best = None
    step = max(1, CELLS // ((2 * most + 1) + len(own)))
    allowed = np.arange(most + 1)
    for a in range(0, len(places), step):
        d, q = places[a : a + step], in_item[a : a + step]
        if best:
            # Points within what was found would find it again.
            out = (d < best[0]) | (d >= best[1])
            d, q = d[out], q[out]
            if not len(d):
                continue
        right, to = _reach(own, text, q, d, most)
        left, back = _reach(own[::-1], text[::-1], len(own) - q, len(text) - d, most)
        for i in range(len(q)):
            after = np.searchsorted(np.maximum.accumulate(right[:, i]), allowed, "right") - 1
            before = np.searchsorted(np.maximum.accumulate(left[:, i]), allowed, "right") - 1
            n = before[:, None] + after[None, :]
            fits = (allowed[:, None] + allowed[None, :] <= np.floor(EDITS * n)) & (n >= least)
            n = np.where(fits, n, -1)
            x, y = np.unravel_index(n.argmax(), n.shape)
            if n[x, y] < 1 or (best and n[x, y] <= best[3] - best[2]):
                continue
            b, f = int(before[x]), int(after[y])
            d0, d1, q0, q1 = int(d[i] - back[b, i]), int(d[i] + to[f, i]), int(q[i] - b), int(q[i] + f)
            best = (d0, d1, q0, q1, banded_distance(own[q0:q1], text[d0:d1], math.floor(EDITS * (q1 - q0))))
        if best and best[3] - best[2] == len(own):
            break
    return best


def _within_repetition(codes: np.ndarray, offsets: np.ndarray, reach: int) -> np.ndarray:
    """Places deep inside a stretch of a row that repeats itself every few bytes.

    What aligns there as a whole also aligns at the stretch's begin, moved by
    whole periods; what passes an end of it stays within ``reach`` of that end.
    So nothing is lost by not looking at these places, and a text of a million
    dashes has no more hits than one of some hundred.
    """
    inside = np.zeros(len(codes), bool)
    for period in range(1, PERIODS + 1):
        same = codes[period:] == codes[:-period]
        if np.count_nonzero(same) <= 2 * reach:
            continue
        # A stretch ends with its row.
        for end in offsets[1:-1]:
            same[max(0, end - period - Q + 1) : end] = False
        edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]])))
        for a, z in zip(edges[::2], edges[1::2]):
            if z - a > 2 * reach:
                inside[a + reach : z - reach] = True
    return inside


def _points(index: Index, data: np.ndarray, offsets: np.ndarray):
    """(row, item, places in the data, places in the item) that leaks must pass through."""
    codes = _codes(data)
    repeated = _within_repetition(codes, offsets, index.reach)
    looked = np.flatnonzero(~repeated)
    places, items, in_item = index.hits(codes[looked])
    places = looked[places]
    rows = np.searchsorted(offsets, places, "right") - 1
    inside = places + Q <= offsets[rows + 1]
    for row, item, p, q in _regions(index, rows[inside], places[inside], items[inside], in_item[inside]):
        yield row, item, *_anchors(p, q)
    repeated = np.concatenate([repeated, np.zeros(len(data) - len(repeated), bool)])
    for places, items, in_item, size in index.piece_hits(data):
        fresh = ~repeated[places]
        places, items, in_item = places[fresh], items[fresh], in_item[fresh]
        rows = np.searchsorted(offsets, places, "right") - 1
        inside = places + size <= offsets[rows + 1]
        rows, items, places, in_item = rows[inside], items[inside], places[inside], in_item[inside]
        order = np.lexsort((items, rows))
        rows, items, places, in_item = rows[order], items[order], places[order], in_item[order]
        starts = np.flatnonzero((np.diff(rows, prepend=-1) != 0) | (np.diff(items, prepend=-1) != 0))
        for a, z in zip(starts, np.append(starts[1:], len(rows))):
            yield int(rows[a]), int(items[a]), places[a:z], in_item[a:z]


def _held(index: Index, texts: pa.Array) -> dict[tuple[int, int], tuple]:
    """The longest region of each item that each text holds, by (row, item)."""
    data, offsets = normalised(*bytes_of(texts))
    found: dict[tuple[int, int], tuple] = {}
    for row, item, p, q in _points(index, data, offsets):
        known = found.get((row, item), (0, 0, 0, 0))
        if known[3] - known[2] == index.lengths[item]:
            continue
        text = data[offsets[row] : offsets[row + 1]]
        region = _best_region(index, text, item, p - offsets[row], q)
        if region and region[3] - region[2] > known[3] - known[2]:
            found[row, item] = region
    return found


def _finder(index: Index):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "item_id", "start", "length", "item_start", "item_length", "edits"]
        for batch in slices(batches):
            found = _held(index, batch.column("text"))
            doc_ids = batch.column("doc_id").to_pylist()
            out = [
                (doc_ids[r], int(index.item_ids[i]), x[0], x[1] - x[0], x[2], x[3] - x[2], x[4])
                for (r, i), x in sorted(found.items())
            ]
            columns = list(zip(*out)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return find


def _cleaner(index: Index, column: str, id_column: str):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            kept = np.ones(batch.num_rows, bool)
            kept[[row for row, _ in _held(index, batch.column(column))]] = False
            yield batch.filter(pc.or_(pa.array(kept), pc.is_null(batch.column(id_column))))

    return clean


def _indexes(benchmark: DataFrame) -> Iterator[Index]:
    """The benchmark in blocks of at most about ``BLOCK_BYTES`` of text."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").alias("text")).where(
        "item_id IS NOT NULL AND text IS NOT NULL"
    )
    total = items.select(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).distinct().collect()
        index = Index([r[0] for r in own], [r[1] for r in own])
        if len(index.data):
            yield index


def leaks(docs: DataFrame, benchmark: DataFrame, column: str = "text") -> DataFrame:
    """One row per document and benchmark item that the document holds.

    ``start`` and ``length`` are in bytes of the document without white space,
    ``item_start`` and ``item_length`` likewise in the item; of several places the
    longest is given. Items without id or text cannot be found; null texts hold
    nothing. Every row is looked at by itself, whatever its id: repeated rows give
    repeated results. Columns other than doc_id and the text are not read.

    The benchmark is read in blocks of at most about ``BLOCK_BYTES``, each of
    which is broadcast and held against all documents.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(column).alias("text"))
    schema = (
        "doc_id BIGINT, item_id BIGINT, start BIGINT, length BIGINT, "
        "item_start BIGINT, item_length BIGINT, edits BIGINT"
    )
    found = None
    for index in _indexes(benchmark):
        part = rows.mapInArrow(_finder(index), schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item. Rows without id stay.

    Each row is judged by its own text, also beside others of its id. All columns
    stay, whatever their names; nothing is joined or shuffled.
    """
    for index in _indexes(benchmark):
        docs = docs.mapInArrow(_cleaner(index, column, "doc_id"), docs.schema)
    return docs
