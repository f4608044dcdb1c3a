"""Collocations: phrases of 2 to 4 words whose parts are seldom seen apart.

The count of a phrase is never above that of its parts (Apriori), so each level
extends only what the level before found frequent. Candidates of a level are
packed into double-array tries and broadcast; every position of a slice of text
moves through the trie at once, one word after the other, and the accepting
states are counted with ``bincount``. The counts of all tasks are summed.

Candidates of the next level come from the same pass: an accepting position adds
one to the bucket of its phrase and the next word's 32-bit hash. The sum of a
bucket is at least the count of any phrase in it, so buckets below the least
count hold no candidate. What is left is completed with the frequent words of
that hash, and kept if the words after the first are frequent as well. Hashes
only choose candidates; a phrase's count is that of its state in the trie.

A word is known by a 64-bit hash of its language and its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .texts import LOWER, SPACE, SpanHash, bytes_of, mix, parts_for, ship_code, slices, stored

LEAST = 30
LONGEST = 4
SHARE = 80
FIRST = 2000
UNKNOWN = "und"
# Candidates in one trie; more go into further tries, one pass over the texts each.
TRIE_PHRASES = 1 << 20
# Bucket entries and distinct words that a task holds before it passes them on.
HELD = 1 << 21
HELD_WORDS = 1 << 18
# Bytes of text whose buckets one task sums.
PART_BYTES = 16 << 20
# Shares of a language that are ranked apart before all of it is; each keeps its first ones.
SHARES = 64
# Frequent words are looked up in this many bits before a bucket is used.
FILTER_BITS = 25

PIECE_END = np.zeros(256, bool)
PIECE_END[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_OUTSIDE = SPACE | PIECE_END
_LANG_STEP = np.uint64(0xD6E8FEB86659FD93)


class PieceWords:
    """Words of a slice of rows: key, place in the bytes, words left in the piece from each on."""

    def __init__(self, batch: pa.RecordBatch):
        data, offsets = bytes_of(batch.column("text"))
        self.data = LOWER[data]
        inside = ~_OUTSIDE[data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        filled = offsets[:-1] < offsets[1:]
        first, last = offsets[:-1][filled], offsets[1:][filled] - 1
        begins[first], ends[last] = inside[first], inside[last]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        n = len(self.starts)
        self.rows = np.searchsorted(offsets, self.starts, "right") - 1
        piece = np.cumsum(PIECE_END[data])[self.starts] if n else np.zeros(0, np.int64)
        new = np.ones(n + 1, bool)
        new[1:n] = (piece[1:] != piece[:-1]) | (self.rows[1:] != self.rows[:-1])
        after = np.flatnonzero(new)
        self.room = np.repeat(after[1:], np.diff(after)) - np.arange(n) if n else np.zeros(0, np.int64)
        letters, bounds = bytes_of(batch.column("lang"))
        lang_keys = SpanHash.of_bytes(letters).spans(bounds[:-1], bounds[1:])
        hashes = SpanHash.of_bytes(self.data).spans(self.starts, self.ends)
        self.keys = mix(hashes + lang_keys[self.rows] * _LANG_STEP)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, word, key and count of distinct words; with a null word, all words of the language."""
    keys, n, place = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    words: list[bytes] = []
    langs: list[str] = []
    totals: dict[str, int] = {}

    def flushed():
        for lang, total in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([None], pa.string()), pa.array([0], pa.int64()), pa.array([total], pa.int64())],
                ["lang", "word", "key", "n"],
            )
        totals.clear()
        order = np.argsort(place)
        for at in range(0, len(order), 1 << 16):
            some = order[at : at + (1 << 16)]
            a, b = at, at + len(some)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(langs[a:b], pa.string()),
                    pa.array(words[a:b], pa.binary()).cast(pa.string()),
                    pa.array(keys[some].view(np.int64)),
                    pa.array(n[some]),
                ],
                ["lang", "word", "key", "n"],
            )

    for batch in slices(batches):
        text = PieceWords(batch)
        if not len(text.keys):
            continue
        names = batch.column("lang").to_pylist()
        for row, count in enumerate(np.bincount(text.rows, minlength=len(names)).tolist()):
            if count:
                totals[names[row]] = totals.get(names[row], 0) + count
        found, first, count = np.unique(text.keys, return_index=True, return_counts=True)
        at = np.minimum(np.searchsorted(keys, found), max(len(keys) - 1, 0))
        known = keys[at] == found if len(keys) else np.zeros(len(found), bool)
        n[at[known]] += count[known]
        first = first[~known]
        data = text.data.tobytes()
        place = np.concatenate([place, len(words) + np.arange(len(first))])
        words += [data[a:b] for a, b in zip(text.starts[first].tolist(), text.ends[first].tolist())]
        langs += [names[r] for r in text.rows[first].tolist()]
        keys = np.concatenate([keys, found[~known]])
        order = np.argsort(keys, kind="stable")
        keys, n, place = keys[order], np.concatenate([n, count[~known]])[order], place[order]
        if len(keys) >= HELD_WORDS:
            yield from flushed()
            keys, n, place, words, langs = keys[:0], n[:0], place[:0], [], []
    yield from flushed()


class Trie:
    """A double array over phrases of one length; each word is two letters of its code.

    A step from state ``s`` by letter ``c`` leads to ``base[s] + c`` if ``check``
    there is ``s``. ``value`` is the place of the phrase that ends at a state.
    """

    _WINDOW = 2048

    def __init__(self, paths: np.ndarray, ids: np.ndarray):
        order = np.lexsort(paths.T[::-1])
        paths, self.ids = paths[order], ids[order]
        self.size, self.length = paths.shape
        self.words, codes = np.unique(paths, return_inverse=True)
        self.radix = int(np.sqrt(len(self.words))) + 1
        letters = np.empty((self.size, 2 * self.length), np.int64)
        letters[:, 0::2], letters[:, 1::2] = np.divmod(codes.reshape(paths.shape), self.radix)
        # Nodes of each depth are the distinct beginnings of the sorted rows.
        new = np.zeros(self.size, bool)
        new[:1] = True
        parents, edges, parent = [], [], np.zeros(self.size, np.int64)
        nodes = 1
        for depth in range(letters.shape[1]):
            new[1:] |= letters[1:, depth] != letters[:-1, depth]
            parents.append(parent[new])
            edges.append(letters[new, depth])
            parent = nodes + np.cumsum(new) - 1
            nodes += len(edges[-1])
        slots, base = self._place(np.concatenate(parents), np.concatenate(edges), nodes)
        self.base = np.zeros(int(slots.max()) + self.radix + 1, np.int32)
        self.check = np.full(len(self.base), -1, np.int32)
        self.value = np.full(len(self.base), -1, np.int32)
        self.base[slots] = base
        self.check[slots[1:]] = slots[np.concatenate(parents)]
        self.value[slots[parent]] = np.arange(self.size)

    def _place(self, parents: np.ndarray, edges: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
        """Slot and base of every node: many children first, only children in what is left."""
        children = np.bincount(parents, minlength=nodes)
        begins = np.concatenate([np.zeros(1, np.int64), np.cumsum(children)])
        order = np.argsort(parents, kind="stable")
        slots, base = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        window, lowest = self._WINDOW, self.radix + 1
        free = np.ones(2 * nodes + 4 * (self.radix + window), bool)
        free[:lowest] = False
        several = np.flatnonzero(children > 1)
        several = several[np.argsort(-children[several], kind="stable")]
        cursor, fewest = lowest, 0
        for node in several.tolist():
            edge = order[begins[node] : begins[node + 1]]
            taken = edges[edge]
            if len(edge) * 2 <= fewest or not fewest:
                cursor, fewest = lowest, len(edge)
            while True:
                if cursor + window + self.radix >= len(free):
                    free = np.concatenate([free, np.ones(len(free), bool)])
                fits = free[cursor + taken[0] : cursor + taken[0] + window].copy()
                for c in taken[1:].tolist():
                    fits &= free[cursor + c : cursor + c + window]
                found = int(fits.argmax())
                if fits[found]:
                    break
                cursor += window
            base[node] = cursor + found
            slots[edge + 1] = base[node] + taken
            free[slots[edge + 1]] = False
        single = np.flatnonzero(children == 1)
        edge = order[begins[single]]
        left = np.flatnonzero(free)
        while len(left) < len(single):
            left = np.concatenate([left, np.arange(len(free), 2 * len(free))])
            free = np.concatenate([free, np.ones(len(free), bool)])
        slots[edge + 1] = left[: len(single)]
        base[single] = slots[edge + 1] - edges[edge]
        return slots, base

    def accepted(self, text: PieceWords) -> tuple[np.ndarray, np.ndarray]:
        """Positions where a phrase begins, and its place."""
        code = np.searchsorted(self.words, text.keys)
        code[code == len(self.words)] = 0
        known = self.words[code] == text.keys
        at = np.flatnonzero(known & (text.room >= self.length))
        high, low = np.divmod(code, self.radix)
        state = np.zeros(len(at), np.int32)
        for step in range(self.length):
            ok = known[at + step]
            at, state = at[ok], state[ok]
            for letter in (high, low):
                reached = self.base[state] + letter[at + step]
                ok = self.check[reached] == state
                at, state = at[ok], reached[ok].astype(np.int32)
        return at, self.value[state]


def _flush(keys: np.ndarray, n: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Rows of distinct keys and their counts, one for each part that has any."""
    if not len(keys):
        return
    part = (mix(keys) % np.uint64(parts)).astype(np.uint16 if parts < 1 << 16 else np.uint32)
    order = np.argsort(part, kind="stable")
    part, keys, n = part[order], keys[order], n[order].astype(np.uint32)
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    limits = np.append(first, len(part)).tolist()
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(part[first].astype(np.int32)),
            pa.array([keys[a:b].tobytes() for a, b in zip(limits[:-1], limits[1:])], pa.binary()),
            pa.array([n[a:b].tobytes() for a, b in zip(limits[:-1], limits[1:])], pa.binary()),
        ],
        ["part", "keys", "n"],
    )


# A key: the phrase's place, one bit that tells a bucket from a count, 32 bits of the next word.
_BUCKET = np.uint64(1 << 32)
_PLACE = np.uint64(33)
_NEXT = np.uint64((1 << 32) - 1)


def _scanner(shared, frequent, parts: int, count: bool, extend: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, words = shared.value, frequent.value
        counts = np.zeros(trie.size, np.int64)
        held, waiting = [], 0
        for batch in slices(batches):
            text = PieceWords(batch)
            at, phrase = trie.accepted(text)
            if count:
                counts += np.bincount(phrase, minlength=trie.size)
            if not extend:
                continue
            more = text.room[at] > trie.length
            following = text.keys[at[more] + trie.length] & _NEXT
            bit = following >> np.uint64(32 - FILTER_BITS)
            maybe = (words[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
            held.append((phrase[more][maybe].astype(np.uint64) << _PLACE) | _BUCKET | following[maybe])
            waiting += len(held[-1])
            if waiting >= HELD:
                yield from _flush(*np.unique(np.concatenate(held), return_counts=True), parts)
                held, waiting = [], 0
        if held:
            yield from _flush(*np.unique(np.concatenate(held), return_counts=True), parts)
        # Sums of a task may pass 32 bits: what is beyond goes into further rows.
        while counts.any():
            some = np.flatnonzero(counts)
            now = np.minimum(counts[some], (1 << 32) - 1)
            yield from _flush(some.astype(np.uint64) << _PLACE, now, parts)
            counts[some] -= now

    return scan


def _summer(shared, least: int):
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # part -> summed keys and counts, and those not summed yet
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        held: dict[int, list] = {}
        waiting: dict[int, int] = {}

        def merge(part: int) -> None:
            keys, n = sums.get(part, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
            keys = np.concatenate([keys, *(np.frombuffer(k, np.uint64) for k, _ in held[part])])
            n = np.concatenate([n, *(np.frombuffer(x, np.uint32).astype(np.int64) for _, x in held[part])])
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sums[part] = keys[first], np.add.reduceat(n, first)
            held[part], waiting[part] = [], 0

        for batch in batches:
            columns = [batch.column(c) for c in ("part", "keys", "n")]
            for part, keys, n in zip(*columns):
                part = part.as_py()
                held.setdefault(part, []).append((keys.as_py(), n.as_py()))
                waiting[part] = waiting.get(part, 0) + len(n.as_py()) // 4
                if waiting[part] >= HELD:
                    merge(part)
        for part in held:
            if held[part]:
                merge(part)
            keys, n = sums.pop(part)
            keys, n = keys[n >= least], n[n >= least]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shared.value.ids[(keys >> _PLACE).astype(np.int64)]),
                    pa.array((keys & _BUCKET) > 0),
                    pa.array((keys & _NEXT).astype(np.int64)),
                    pa.array(n),
                ],
                ["id", "is_bucket", "next", "n"],
            )

    return total


FOUND = "id BIGINT, is_bucket BOOLEAN, next BIGINT, n BIGINT"


def _numbered(df: DataFrame, purpose: str) -> DataFrame:
    return stored(df.withColumn("id", F.monotonically_increasing_id()), purpose)


def _passes(texts: DataFrame, candidates: DataFrame, frequent, parts: int, least: int, limit: int, count: bool, extend: bool):
    """Counts and buckets of all candidates that reach the least count, one pass for each trie."""
    spark = texts.sparkSession
    tries = -(-candidates.count() // limit)
    found = []
    for i in range(tries):
        rows = candidates.where(F.pmod(F.xxhash64("id"), F.lit(tries)) == i).select("id", "path").toArrow()
        if not rows.num_rows:
            continue
        path = rows.column("path").combine_chunks()
        paths = path.flatten().to_numpy().view(np.uint64).reshape(rows.num_rows, -1)
        shared = spark.sparkContext.broadcast(Trie(paths, rows.column("id").to_numpy()))
        scanned = texts.mapInArrow(_scanner(shared, frequent, parts, count, extend), "part INT, keys BINARY, n BINARY")
        summed = scanned.repartition(parts, "part").mapInArrow(_summer(shared, least), FOUND)
        found.append(stored(summed, "phrases"))
        shared.destroy()
    if not found:
        return spark.createDataFrame([], FOUND)
    return reduce(DataFrame.unionAll, found)


def phrase_counts(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, limit: int = TRIE_PHRASES
) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``longest`` words seen at least ``least`` times, and all words by language.

    The first frame has lang, phrase (words joined by a space), size and n; the
    second lang and n, over all words however rare. A trie holds at most
    ``limit`` phrases.
    """
    spark = docs.sparkSession
    ship_code(spark)
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text").where("text <> ''")
    parts = parts_for(texts, "text", PART_BYTES)
    counted = texts.mapInArrow(_count_words, "lang STRING, word STRING, key BIGINT, n BIGINT")
    counted = counted.groupBy("lang", "word").agg(F.max("key").alias("key"), F.sum("n").alias("n"))
    counted = stored(counted.where(F.col("word").isNull() | (F.col("n") >= least)), "frequent-words")
    totals = counted.where("word IS NULL").select("lang", "n")
    words = counted.where("word IS NOT NULL").withColumn("next", F.col("key").bitwiseAND(F.lit((1 << 32) - 1)))
    # At most one bit of 2^25 for each frequent word.
    bits = words.select(F.shiftright("next", 32 - FILTER_BITS).alias("bit")).distinct().toArrow().column("bit").to_numpy()
    table = np.zeros(1 << FILTER_BITS, bool)
    table[bits] = True
    frequent = spark.sparkContext.broadcast(np.packbits(table, bitorder="little"))
    candidates = _numbered(
        words.select("lang", F.col("word").alias("phrase"), F.array("key").alias("path"), "n"), "candidates"
    )
    levels = [candidates.select("lang", "phrase", F.lit(1).alias("size"), "n")]
    for size in range(1, longest + 1):
        found = _passes(texts, candidates.select("id", "path"), frequent, parts, least, limit, size > 1, size < longest)
        if size > 1:
            counts = found.where("NOT is_bucket").select("id", "n")
            here = candidates.join(counts, "id").select("lang", "phrase", F.lit(size).alias("size"), "n")
            levels.append(stored(here, "level"))
        if size == longest:
            break
        grown = (
            candidates.drop("n")
            .join(found.where("is_bucket").select("id", "next"), "id")
            .join(words.select("lang", "next", "word", "key"), ["lang", "next"])
            .select(
                "lang",
                F.concat_ws(" ", "phrase", "word").alias("phrase"),
                F.concat("path", F.array("key")).alias("path"),
                F.concat_ws(" ", F.expr("substring(phrase, nullif(locate(' ', phrase), 0) + 1)"), "word").alias("tail"),
            )
        )
        if size > 1:
            grown = grown.join(levels[-1].select("lang", F.col("phrase").alias("tail")), ["lang", "tail"], "left_semi")
        candidates = _numbered(grown.drop("tail"), "candidates")
    frequent.destroy()
    return reduce(DataFrame.unionAll, levels), totals


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    share: int = SHARE,
    first: int | None = FIRST,
    limit: int = TRIE_PHRASES,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases.

    ``a`` is the phrase's count, ``l`` and ``r`` those of the two parts of its
    lowest-scoring cut, ``n`` the language's words, ``score`` 2,000,000 a / (l +
    r) without its fraction; ties of cuts go to the shortest first part. A phrase inside
    a longer one with at least ``share`` percent of its count is left out. Ranks
    go by score, count and phrase (in order of bytes), up to ``first``.

    A null text has no words; a null lang is ``und``. Repeated rows count each;
    an empty table, or one without frequent phrases, gives no rows; columns other
    than lang and text are not read.
    """
    phrases, totals = phrase_counts(docs, least, longest, limit)
    phrases = stored(phrases, "frequent-phrases")
    known = phrases.select("lang", F.col("phrase").alias("part"), "n")
    long = phrases.where("size > 1").withColumnRenamed("n", "a")
    cuts = (
        long.select("lang", "phrase", "a", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
        .withColumn("head", F.expr("substring_index(phrase, ' ', k)"))
        .withColumn("tail", F.expr("substring(phrase, length(head) + 2)"))
        .join(known.select("lang", F.col("part").alias("head"), F.col("n").alias("l")), ["lang", "head"])
        .join(known.select("lang", F.col("part").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
        .withColumn(
            "score", F.expr("(CAST(2000000 AS DECIMAL(38,0)) * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + r)")
        )
    )
    lowest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("cut"))
    # Every phrase inside each longer one, with the highest count of those around it.
    places = "flatten(transform(sequence(1, size - 1), i -> transform(sequence(2, least(size - 1, size - i + 1)), j -> struct(i, j))))"
    around = (
        long.where("size > 2")
        .select("a", "lang", F.split("phrase", " ").alias("words"), F.explode(F.expr(places)).alias("at"))
        .select("lang", F.expr("concat_ws(' ', slice(words, at.i, at.j))").alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("around"))
    )
    kept = (
        lowest.join(around, ["lang", "phrase"], "left")
        .where(F.col("around").isNull() | (F.col("around") * 100 < F.col("cut.a") * share))
        .select("lang", "phrase", "cut.*")
    )
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if first is not None:
        # The first of each share of a language, so that no task sorts all of its phrases.
        kept = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
        place = F.row_number().over(Window.partitionBy("lang", "share").orderBy(*best))
        kept = kept.withColumn("rank", place).where(F.col("rank") <= first).drop("share", "rank")
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint"))
    if first is not None:
        ranked = ranked.where(F.col("rank") <= first)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = f"""
    WITH pieces AS (
        SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(regexp_split_to_array(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents WHERE text <> ''
    ), words AS (
        SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces
    ), grams AS (
        SELECT lang, size, unnest(list_transform(
            range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) AS phrase
        FROM words, (VALUES (1), (2), (3), (4)) AS sizes(size)
    ), counts AS (
        SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY ALL
    ), totals AS (
        SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang
    ), candidates AS (
        SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS ws FROM counts WHERE size > 1 AND n >= {LEAST}
    ), heads AS (
        SELECT lang, phrase, a, size, ws, unnest(range(1, size)) AS k FROM candidates
    ), cuts AS (
        SELECT h.lang, h.phrase, h.a, h.k, x.n AS l, y.n AS r,
            CAST((CAST(2000000 AS HUGEINT) * h.a) // (x.n + y.n) AS BIGINT) AS score
        FROM heads h
        JOIN counts x ON x.lang = h.lang AND x.phrase = array_to_string(h.ws[1:h.k], ' ')
        JOIN counts y ON y.lang = h.lang AND y.phrase = array_to_string(h.ws[h.k + 1:h.size], ' ')
    ), lowest AS (
        SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ), inside AS (
        SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase
        FROM candidates WHERE size = 3
        UNION ALL
        SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' '), array_to_string(ws[3:4], ' '),
            array_to_string(ws[1:3], ' '), array_to_string(ws[2:4], ' ')]) AS phrase
        FROM candidates WHERE size = 4
    ), kept AS (
        SELECT * FROM lowest x WHERE NOT EXISTS (
            SELECT 1 FROM inside y WHERE y.lang = x.lang AND y.phrase = x.phrase AND 100 * y.a >= {SHARE} * x.a)
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
    )
    SELECT ranked.lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, totals.n AS n, score
    FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= {FIRST}
"""
