"""Best-fit packing of token pieces into sequences of one length.

Only the number of pieces of each length matters for the plan, at most
``capacity`` numbers, so the plan is made from a histogram: combinations of one
to four pieces that fill a sequence exactly are used up as often as their pieces
last, and what remains is placed best fit first. Pieces are ranked within their
length by prefix sums of the tasks' counts, and a piece's rank says which sequence
of the plan it takes.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .texts import Words, slices, stored
from .tokenizer_files import WordEncoder

CAPACITY = 2048
PIECE_SCHEMA = "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT"
# The task that cut a piece, and how many of its length that task had cut before.
CUT_SCHEMA = f"{PIECE_SCHEMA}, part INT, place BIGINT"


PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]


def default_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def _cutter(path: str, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part_id, cut_before = WordEncoder(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in slices(batches):
            ids, counts = encoder.encode(Words(batch.column("text"), lower=False))
            out: list[list] = [[], [], [], [], []]
            at = 0
            for doc_id, count in zip(batch.column("doc_id").to_pylist(), counts):
                own = np.zeros(count + 1, "<u4")  # id 0 ends the document
                own[:count] = ids[at : at + count]
                at += count
                for piece, start in enumerate(range(0, len(own), capacity)):
                    part = own[start : start + capacity]
                    row = (doc_id, piece, start, len(part), zlib.crc32(part.tobytes()))
                    for column, value in zip(out, row):
                        column.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            lengths = np.array(out[3], np.int64)
            order = np.argsort(lengths, kind="stable")
            own = np.bincount(lengths, minlength=capacity + 1)
            place = np.empty(len(lengths), np.int64)
            place[order] = np.arange(len(lengths)) - np.repeat(np.cumsum(own) - own - cut_before, own)
            cut_before += own
            columns = [pa.array(c, t) for c, t in zip(out, types)]
            columns += [pa.array(np.full(len(place), part_id, np.int32)), pa.array(place)]
            yield pa.RecordBatch.from_arrays(columns, [*PIECE_NAMES, "part", "place"])

    return cut


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, column: str = "text") -> DataFrame:
    """The documents' pieces: ids of the whole text, then id 0, cut at ``capacity``.

    A null or empty text is the one id 0. Every row is a document, also if its
    id is null or repeated. ``part`` and ``place`` number the pieces of a length
    within the task that cut them: store the result before it is used, so that
    they are those of one run.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(column).alias("text"))
    return rows.mapInArrow(_cutter(path or default_path(), capacity), CUT_SCHEMA)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """How to fill sequences: (lengths in one sequence, how many such sequences).

    From the longest length down, what fills the gap exactly is looked up in the
    sums of one, two and three lengths that are still there. Each entry uses up
    at least one length, so the plan has at most about twice as many entries as
    there are lengths.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    out: list[tuple[tuple[int, ...], int]] = []

    def use(combination: tuple[int, ...]) -> bool:
        need: dict[int, int] = {}
        for x in combination:
            need[x] = need.get(x, 0) + 1
        times = min(int(left[x]) // n for x, n in need.items())
        if times:
            for x, n in need.items():
                left[x] -= n * times
            out.append((combination, times))
        return times > 0

    def pairs(total: int, most: int, first: tuple[int, ...]) -> Iterator[tuple[int, int]]:
        """Two lengths of this sum, the longer of at most ``most``, both there beside ``first``."""
        high = np.arange((total + 1) // 2, min(total - 1, most) + 1)
        low = total - high
        fits = (left[high] > 0) & (left[low] > 0)
        for a, b in zip(high[fits][::-1].tolist(), low[fits][::-1].tolist()):
            yield a, b

    def fill(length: int) -> None:
        gap = capacity - length
        if gap == 0:
            use((length,))
            return
        if left[gap] and use((length, gap)) and not left[length]:
            return
        for a, b in pairs(gap, gap, (length,)):
            if use((length, a, b)) and not left[length]:
                return
        for a in range(gap - 2, 0, -1):
            if not left[a]:
                continue
            for b, c in pairs(gap - a, a, (length, a)):
                if use((length, a, b, c)) and not left[length]:
                    return
                if not left[a]:
                    break

    for length in range(capacity, 0, -1):
        if left[length]:
            fill(length)
    return out + _best_fit(left, capacity)


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The rest, longest first, each into the open sequence that it fills most."""
    gaps: list[int] = []  # sorted
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(lengths: tuple[int, ...], times: int) -> None:
        gap = capacity - sum(lengths)
        if gap not in open_:
            bisect.insort(gaps, gap)
            open_[gap] = []
        open_[gap].append((lengths, times))

    for length in range(capacity, 0, -1):
        count = int(left[length])
        while count:
            at = bisect.bisect_left(gaps, length)
            if at == len(gaps):
                each = capacity // length
                if count >= each:
                    put((length,) * each, count // each)
                if count % each:
                    put((length,) * (count % each), 1)
                break
            gap = gaps[at]
            lengths, times = open_[gap].pop()
            if not open_[gap]:
                del open_[gap]
                gaps.pop(at)
            used = min(times, count)
            if times > used:
                put(lengths, times - used)
            put((*lengths, length), used)
            count -= used
    return [group for groups in open_.values() for group in groups]


def _intervals(made: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted: what each rank takes."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, times in made:
        offset = 0
        for length in lengths:
            rows.append((length, used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + times
            offset += length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def _placer(intervals: np.ndarray, shift: int):
    starts = (intervals[:, 0] << shift) + intervals[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(starts, (length << shift) + rank, "right") - 1
            names = PIECE_NAMES
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names),
                    pa.array(intervals[at, 2] + rank - intervals[at, 1]),
                    pa.array(intervals[at, 3]),
                ],
                [*names, "sequence_id", "offset"],
            )

    return place


def pack(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give each row of :func:`pieces` its sequence and its place there.

    ``made`` is read twice and has to be stored. A piece's rank among those of
    its length is its place in its task plus what the tasks before have cut of
    that length: nothing but these counts is sorted, so no length is too common.
    The driver sees one number per length. No pieces give no rows.
    """
    counts = made.groupBy("length", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = stored(counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "cut-before")
    totals = {r["length"]: r["n"] for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranked = made.join(before.drop("n"), ["length", "part"]).withColumn("rank", F.col("place") + F.col("before"))
    placer = _placer(_intervals(plan(totals, capacity)), 48)
    return ranked.select(*PIECE_NAMES, "rank").mapInArrow(placer, f"{PIECE_SCHEMA}, sequence_id BIGINT, offset BIGINT")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Cut the documents' ids into pieces, store those, and pack them."""
    return pack(stored(pieces(docs, path, capacity), "pieces"), capacity)
