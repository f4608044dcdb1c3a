"""Whole columns of text as byte arrays: words, hashes, windows.

The operators see the texts of an Arrow batch as one array of bytes with the
offset of each row. A word is a run of bytes other than space and 0x09 to 0x0D;
it is known by a 64-bit hash. A null text is an empty one.
"""

from __future__ import annotations

import pathlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import run_dir

# Bytes of text worked on at once; one longer text is worked on alone.
SLICE_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 3
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD1342543DE82EF95)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


class SpanHash:
    """Hashes of any spans of a sequence of 64-bit codes, from one running sum."""

    def __init__(self, codes: np.ndarray):
        power, self._inverse = _power(len(codes))
        self._sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * power[: len(codes)], out=self._sums[1:])

    @classmethod
    def of_bytes(cls, data: np.ndarray) -> SpanHash:
        return cls(_BYTE_CODES[data])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._inverse[starts])


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of at most ``limit`` bytes, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each row begins (and the last ends)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of a text column: ``starts`` and ``ends`` in ``data``, ``bounds`` per row."""

    def __init__(self, column: pa.Array, lower: bool = True):
        data, self.offsets = bytes_of(column)
        self.data = LOWER[data] if lower else data
        inside = ~SPACE[data]
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        filled = self.offsets[:-1] < self.offsets[1:]
        first, last = self.offsets[:-1][filled], self.offsets[1:][filled] - 1
        starts[first], ends[last] = inside[first], inside[last]
        self.starts, self.ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.bounds)
        self.rows = np.repeat(np.arange(len(column)), self.counts)

    def hashes(self) -> np.ndarray:
        return SpanHash.of_bytes(self.data).spans(self.starts, self.ends)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` word hashes, whatever rows they belong to."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * _STEP + hashes[i : i + n]
    return mix(out)


def digests(words: Words, hashes: np.ndarray) -> np.ndarray:
    """128 bits per row (as two columns) that stand for its sequence of words."""
    place = np.arange(len(hashes), dtype=np.uint64) - np.repeat(words.bounds[:-1], words.counts).astype(np.uint64)
    out = np.zeros((len(words.counts), 2), np.uint64)
    for i, seed in enumerate((0x5851F42D4C957F2D, 0x14057B7EF767814F)):
        coded = mix(hashes + mix(place * np.uint64(seed) + np.uint64(i + 1)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(coded, dtype=np.uint64)])
        out[:, i] = mix(sums[words.bounds[1:]] - sums[words.bounds[:-1]] + words.counts.astype(np.uint64))
    return out


def sliding(least, values: np.ndarray, size: int) -> np.ndarray:
    """``np.minimum`` or ``np.maximum`` over each run of ``size`` values."""
    if len(values) < size:
        return values[:0]
    span = 1
    while span * 2 <= size:
        values = least(values[:-span], values[span:])
        span *= 2
    rest = size - span
    return least(values[:-rest], values[rest:]) if rest else values


class Memo:
    """Values by 64-bit key, kept from slice to slice up to ``limit`` keys.

    The limit bounds memory only: what is forgotten is computed again.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.keys = np.zeros(0, np.uint64)
        self.values: np.ndarray | None = None

    def get(self, keys: np.ndarray, compute) -> np.ndarray:
        """Values of sorted distinct ``keys``; ``compute(i)`` gives those at places ``i``."""
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        missing = np.flatnonzero(~known)
        if self.values is None or len(missing) == len(keys):
            out = compute(missing)
        else:
            out = self.values[at]
            if len(missing):
                out[missing] = compute(missing)
        if len(missing):
            if self.values is None or len(self.keys) + len(missing) > self.limit:
                self.keys, self.values = keys, out
            else:
                merged = np.concatenate([self.keys, keys[missing]])
                order = np.argsort(merged, kind="stable")
                self.keys = merged[order]
                self.values = np.concatenate([self.values, out[missing]])[order]
        return out


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df`` from Parquet files in the shared folder.

    They outlive lost executors and cut the lineage. The result of an operator
    is lazy and reads them, so they stay until the shared folder is cleared.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark, purpose)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark context.

    Tasks import it, and a cluster need not have it installed. What is packed
    here is code alone; Spark serves the file from the driver.
    """
    context = spark.sparkContext
    if getattr(context, "_rollcall_shipped", False):
        return
    package = pathlib.Path(__file__).resolve().parents[1]
    path = pathlib.Path(tempfile.mkdtemp(prefix="rollcall-code-")) / "rollcall_code.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(path))
    context._rollcall_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_training(df: DataFrame, modulus: int, held_out: int):
    """Whether a document belongs to the training part: by crc32 of its id as text."""
    return F.crc32(F.coalesce(df["doc_id"].cast("string"), F.lit("")).cast("binary")) % modulus != held_out


def parts_for(df: DataFrame, column: str, per_part: int) -> int:
    """Number of hash parts so that each holds about ``per_part`` bytes of ``column``."""
    total = df.select(F.sum(F.octet_length(column))).first()[0] or 0
    return max(1, -(-int(total) // per_part))
