"""Repeated passages by fingerprints of runs of words.

No suffixes are sorted. Of all places only content-selected ones are retained:
in each run of ``MIN_WORDS`` words, where the hash of eight words is least. Two
equal runs choose the same place, so a repeated passage shows as retained hashes
that occur more than once. Around those all runs of ``MIN_WORDS`` words are
hashed and grouped. Repeated runs that overlap join into spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import SpanHash, Words, mix, slices, sliding, stored, windows

MIN_WORDS = 50
SEED_WORDS = 8


REACH = MIN_WORDS - SEED_WORDS + 1


def _key(columns: list[str]) -> list[str]:
    """What names a document: doc_id, and code where :func:`_keyed` needs it."""
    return [c for c in ("doc_id", "code") if c in columns]


def _choices(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each suffix's beginning, and per run of ``MIN_WORDS`` words the one it retains.

    The second is 0 where the run would leave its text.
    """
    n = len(hashes) - MIN_WORDS + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    order = mix(windows(hashes, SEED_WORDS)) | np.uint64(1)
    least = sliding(np.minimum, order, REACH)
    return order, np.where(words.rows[:n] == words.rows[MIN_WORDS - 1 :], least, np.uint64(0))


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Retained suffixes per document: beginning, and number of places."""
    for batch in slices(batches):
        words = Words(batch.column("text"))
        order, chosen = _choices(words, words.hashes())
        # A place is retained if one of the runs around it chose its hash.
        pad = np.zeros(REACH - 1, np.uint64)
        around = sliding(np.maximum, np.concatenate([pad, chosen, pad]), REACH) if len(chosen) else chosen
        at = np.flatnonzero((around == order) & (around > 0))
        if not len(at):
            continue
        keys, rows = order[at], words.rows[at]
        by_row = np.lexsort((keys, rows))
        keys, rows = keys[by_row], rows[by_row]
        new = np.flatnonzero((np.diff(keys, prepend=np.uint64(0)) != 0) | (np.diff(rows, prepend=-1) != 0))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys[new].view(np.int64)),
                *(batch.column(c).take(pa.array(rows[new])) for c in _key(batch.schema.names)),
                pa.array(np.diff(new, append=len(keys)).astype(np.int32)),
            ],
            ["suffix", *_key(batch.schema.names), "places"],
        )


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole runs around the suffixes whose beginning occurs again."""
    for batch in slices(batches):
        words = Words(batch.column("text"))
        hashes = words.hashes()
        _, chosen = _choices(words, hashes)
        suffixes = batch.column("suffixes")
        owner = np.repeat(np.arange(batch.num_rows), np.diff(suffixes.offsets.to_numpy()))
        wanted = suffixes.flatten().to_numpy().view(np.uint64)
        rows = words.rows[: len(chosen)]
        step = np.uint64(0x9E3779B97F4A7C15)
        at = np.flatnonzero(
            (chosen > 0)
            & np.isin(mix(chosen + rows.astype(np.uint64) * step), mix(wanted + owner.astype(np.uint64) * step))
        )
        if len(at):
            runs = SpanHash(hashes).spans(at, at + MIN_WORDS)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(runs.view(np.int64)),
                    *(batch.column(c).take(pa.array(rows[at])) for c in _key(batch.schema.names)),
                    pa.array((at - words.bounds[rows[at]]).astype(np.int32)),
                ],
                ["run", *_key(batch.schema.names), "start"],
            )


def _keyed(docs: DataFrame, column: str) -> DataFrame:
    """row (all of ``docs``), text, and the doc_id or doc_id and code that name one document.

    Rows equal in id and text are one document; rows of one id with different
    texts are told by a hash of the text. Rows without id are each a document of
    its own: they are written once with a number, so that every reading gives
    them the same. A table without such rows has no code, which would only take
    disk.
    """
    rows = docs.select(F.struct("*").alias("row"))
    doc_id, text = F.col("row.doc_id").cast("bigint"), F.col(f"row.`{column}`")
    code = F.xxhash64(text)
    by_id = rows.select(doc_id.alias("doc_id"), code.alias("code")).groupBy("doc_id")
    nameless, several = (
        by_id.agg((F.min("code") < F.max("code")).alias("several"))
        .agg(F.max(F.col("doc_id").isNull()), F.max("several"))
        .first()
    )
    if nameless or several:
        named = rows.where(doc_id.isNotNull()).withColumn("code", code)
        rows = named.unionByName(
            stored(rows.where(doc_id.isNull()).withColumn("code", F.monotonically_increasing_id()), "nameless")
        )
    key = [doc_id.alias("doc_id"), *(F.col(c) for c in rows.columns if c == "code")]
    return rows.select("row", *key, text.alias("text"))


def _same(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join by document."""
    key = _key(left.columns)
    named = right.withColumnsRenamed({c: f"__{c}" for c in key})
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key]
    return left.join(named, same, how).drop(*(f"__{c}" for c in key))


def repeated_runs(rows: DataFrame) -> DataFrame:
    """Per document the starts (in words) of runs that occur again, and of those to cut.

    Rows have the key and text of :func:`_keyed`. Of equal runs the one with the
    least (key, start) stays, null ids first; the others are cut.
    Copies within one text count too. A run found only in equal rows of one
    doc_id at one place stays in all of them. Texts of fewer than ``MIN_WORDS``
    words, null texts and empty tables give no rows.
    """
    key = _key(rows.columns)
    types = ", ".join(f"{c} BIGINT" for c in key)
    rows = rows.select(*key, "text")
    suffixes = stored(rows.mapInArrow(_suffixes, f"suffix BIGINT, {types}, places INT"), "suffixes")
    shared = suffixes.groupBy("suffix").agg(F.sum("places").alias("n")).where("n > 1").select("suffix")
    per_doc = suffixes.join(shared, "suffix").groupBy(*key).agg(F.collect_set("suffix").alias("suffixes"))
    runs = stored(_same(rows, per_doc).mapInArrow(_extend, f"run BIGINT, {types}, start INT"), "runs")
    place = F.struct(*key, "start")
    again = (
        runs.groupBy("run")
        .agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .where("n > 1")
        .select("run", "first")
    )
    cut = ~place.eqNullSafe(F.col("first"))
    return (
        runs.join(again, "run")
        .groupBy(*key)
        .agg(
            F.collect_set("start").alias("starts"),
            F.collect_set(F.when(cut, F.col("start"))).alias("cuts"),
        )
    )


def _covered(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans [from, to) of words covered by runs at the sorted ``starts``."""
    if not len(starts):
        return starts, starts
    new = np.flatnonzero(np.diff(starts, prepend=-MIN_WORDS - 1) > MIN_WORDS)
    last = np.append(new[1:], len(starts)) - 1
    return starts[new], starts[last] + MIN_WORDS


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for doc_id, starts, cuts in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "starts", "cuts"))):
            begin, end = _covered(np.sort(np.array(starts, np.int64)))
            cut_begin, cut_end = _covered(np.sort(np.array(cuts, np.int64)))
            for a, b in zip(begin.tolist(), end.tolist()):
                inside = np.minimum(cut_end, b) - np.maximum(cut_begin, a)
                row = (doc_id, a, b - a, int(inside[inside > 0].sum()))
                for values, value in zip(out, row):
                    values.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in out], ["doc_id", "start_word", "n_words", "n_cut"]
        )


def repeated_spans(docs: DataFrame, column: str = "text") -> DataFrame:
    """One row per maximal repeated span of a document: where, how long, words to cut.

    Rows without id are documents of their own, with a null doc_id in the result.
    """
    return repeated_runs(_keyed(docs.select("doc_id", column), column)).mapInArrow(
        _spans, "doc_id BIGINT, start_word BIGINT, n_words BIGINT, n_cut BIGINT"
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, cuts in zip(batch.column("text").to_pylist(), batch.column("cuts").to_pylist()):
            if cuts:
                words = Words(pa.array([text], pa.string()))
                data = text.encode()
                begins = np.append(words.starts, len(data))
                parts, at = [], 0
                for a, b in zip(*(x.tolist() for x in _covered(np.sort(np.array(cuts, np.int64))))):
                    parts.append(data[at : begins[a]])
                    at = begins[b]
                parts.append(data[at:])
                text = b"".join(parts).decode()
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])


def remove_repeats(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with repeated spans cut from the text, all but one copy of each.

    All rows and columns stay; ``n_chars``, if there, is counted anew.
    """
    rows = _keyed(docs, column)
    cuts = repeated_runs(rows).drop("starts").where(F.size("cuts") > 0)
    rows = _same(rows, cuts, "left").select("row", "text", "cuts")
    cleaned = rows.mapInArrow(
        _cut, f"row {docs.schema.simpleString()}, text STRING"
    )
    columns = [
        F.col("text").alias(c)
        if c == column
        else F.char_length("text").cast(t).alias(c)
        if c == "n_chars"
        else F.col(f"row.`{c}`").alias(c)
        for c, t in docs.dtypes
    ]
    return cleaned.select(*columns)
