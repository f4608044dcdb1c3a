"""Near-duplicates by improved consistent weighted sampling.

A document is a bag of five-word shingles. The weight of a shingle is how often
the text has it, times an inverse document frequency between 1 (all documents
have it) and 1.5 (at most one in a hundred has it). Forty weighted samples, in
ten bands of four, name candidates; these are verified by the weighted Jaccard
similarity of their whole bags, and verified links make classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .texts import Words, digests, mix, slices, stored, windows

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 10, 4
SAMPLES = BANDS * ROWS

# A shingle that at least this share of the documents has is a common one. There
# are at most (shingles of a document on average) / COMMON common shingles,
# whatever the number of documents, so their table may be broadcast.
COMMON = 0.01
MOST_IDF = 1.5
# Counters that find which shingles can be common; exact counts follow.
COUNTERS = 1 << 20
COUNTER_BLOCK = 1 << 14
# Pairs whose samples agree less often than this are not worth a look: at a true
# similarity of 0.8, so few of forty agree about once in ten thousand.
LEAST_AGREEMENT = 0.55
# Members of a band's bucket that are compared as one block, with another one.
BLOCK = 500
# Members verified against one representative in one task.
CHUNK = 512


def shingles(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every shingle, repeated ones too. A text of fewer words is one shingle."""
    n = max(len(hashes) - SHINGLE + 1, 0)
    inside = words.rows[:n] == words.rows[SHINGLE - 1 :][:n]
    keys, rows = windows(hashes, SHINGLE)[inside], words.rows[:n][inside]
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    if len(short):
        own = [windows(hashes[words.bounds[r] : words.bounds[r + 1]], words.counts[r])[0] for r in short]
        keys, rows = np.append(keys, np.array(own, np.uint64)), np.append(rows, short)
    return keys, rows


class Bags:
    """The weighted shingles of a text column, sorted by row and hash."""

    def __init__(self, words: Words, common: tuple[np.ndarray, np.ndarray]):
        self.hashes = words.hashes()
        keys, rows = shingles(words, self.hashes)
        order = np.lexsort((keys, rows))
        keys, rows = keys[order], rows[order]
        new = np.flatnonzero((np.diff(keys, prepend=np.uint64(0)) != 0) | (np.diff(rows, prepend=-1) != 0))
        self.keys, self.rows = keys[new], rows[new]
        self.times = np.diff(new, append=len(keys))
        self.bounds = np.searchsorted(self.rows, np.arange(len(words.counts) + 1))
        self.weights = self.times * idf(self.keys, common)


def idf(keys: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    known, weights = common
    if not len(known):
        return np.full(len(keys), MOST_IDF)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, weights[at], MOST_IDF)


def _buckets(keys: np.ndarray) -> np.ndarray:
    return (mix(keys) % np.uint64(COUNTERS)).astype(np.int64)


def _count_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counters = np.zeros(COUNTERS, np.int64)
    for batch in slices(batches):
        words = Words(batch.column("text"))
        keys, _ = shingles(words, words.hashes())
        counters += np.bincount(_buckets(keys), minlength=COUNTERS)
    if counters.any():
        blocks = counters.reshape(-1, COUNTER_BLOCK)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(blocks), dtype=np.int32)), pa.array([b.astype("<u4").tobytes() for b in blocks], pa.binary())],
            ["block", "counters"],
        )


def _sum_blocks(least: float):
    def total(key, frame):
        import pandas as pd

        sums = sum(np.frombuffer(b, "<u4").astype(np.int64) for b in frame["counters"])
        return pd.DataFrame({"bucket": key[0] * COUNTER_BLOCK + np.flatnonzero(sums >= least)})

    return total


def _count_shingles(buckets: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(COUNTERS, bool)
        wanted[buckets] = True
        for batch in slices(batches):
            words = Words(batch.column("text"))
            keys, rows = shingles(words, words.hashes())
            maybe = wanted[_buckets(keys)]
            distinct = np.unique(np.rec.fromarrays([keys[maybe], rows[maybe]], names="key,row"))
            keys, n = np.unique(distinct["key"], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["shingle", "n"])

    return count


def common_shingles(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The common shingles of all documents, sorted, with their weights.

    A fixed number of counters bounds each shingle's frequency from above; those
    that may be common are then counted exactly.
    """
    total = rows.count()
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0)
    least = max(1.0, COMMON * total)
    blocks = rows.select("text").mapInArrow(_count_buckets, "block INT, counters BINARY")
    hot = blocks.groupBy("block").applyInPandas(_sum_blocks(least), "bucket BIGINT")
    buckets = np.array([r[0] for r in hot.collect()], np.int64)
    counted = (
        rows.select("text")
        .mapInArrow(_count_shingles(buckets), "shingle BIGINT, n BIGINT")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
    )
    found = sorted((r[0] % (1 << 64), r[1]) for r in counted.collect())
    share = np.array([n for _, n in found], float) / total
    weights = 1 + (MOST_IDF - 1) * np.minimum(1, np.log(1 / share) / math.log(1 / COMMON))
    return np.array([k for k, _ in found], np.uint64), weights


def _gamma_quantiles(n: int) -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at the middles of ``n`` equal parts."""
    u = (np.arange(n) + 0.5) / n
    x = np.full(n, 2.0)
    for _ in range(60):  # Newton steps on 1 - (1 + x) exp(-x) = u
        error = 1 - (1 + x) * np.exp(-x) - u
        x = np.clip(x - error / np.maximum(x * np.exp(-x), 1e-12), x / 4, x + 4)
    return x


_TABLE = _gamma_quantiles(1 << 16)
_R, _LOG_C = _TABLE.astype(np.float32), np.log(_TABLE).astype(np.float32)


def samples(bags: Bags) -> np.ndarray:
    """Consistent weighted samples: (rows with a shingle) x SAMPLES of 32 bits.

    Per shingle and sample, r and c follow Gamma(2, 1) and beta is uniform, all
    from the shingle's hash. With t = floor(ln w / r + beta) the shingle of least
    ln c - r (t + 1 - beta) is drawn, together with t. Two bags draw alike with a
    probability of their weighted Jaccard similarity.
    """
    starts = bags.bounds[:-1][np.diff(bags.bounds) > 0]
    sizes = np.diff(np.append(starts, len(bags.keys)))
    out = np.zeros((len(starts), SAMPLES), np.uint32)
    log_w = np.log(bags.weights).astype(np.float32)
    owner = np.repeat(np.arange(len(starts)), sizes)
    for k in range(SAMPLES):
        z = bags.keys * np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 & ((1 << 64) - 1))
        z ^= z >> np.uint64(32)
        z *= np.uint64(0xD6E8FEB86659FD93)
        r = _R[z & np.uint64(0xFFFF)]
        beta = (z >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
        t = np.floor(log_w / r + beta)
        a = _LOG_C[(z >> np.uint64(16)) & np.uint64(0xFFFF)] - r * (t + 1 - beta)
        least = np.minimum.reduceat(a, starts)
        drawn = np.flatnonzero(a == least[owner])
        # Of equal values (there hardly are any) the least hash is drawn.
        drawn = drawn[np.lexsort((z[drawn], owner[drawn]))]
        drawn = drawn[np.diff(owner[drawn], prepend=-1) != 0]
        sample = mix(bags.keys[drawn] + (t[drawn].astype(np.int64) + 1000).astype(np.uint64))
        out[:, k] = (sample >> np.uint64(32)).astype(np.uint32)
    return out


def _sketcher(common: tuple[np.ndarray, np.ndarray]):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(batch.column("text"))
            bags = Bags(words, common)
            code = digests(words, bags.hashes)
            some = np.flatnonzero(words.counts > 0)
            drawn = samples(bags).astype(np.uint64)
            bands = np.zeros((len(some), BANDS), np.uint64)
            for i in range(SAMPLES):
                band = i // ROWS
                bands[:, band] = mix(bands[:, band] * np.uint64(3) + drawn[:, i] + np.uint64(1))
            small = drawn.astype("<u4")
            filled = words.counts > 0
            sketches: list = [None] * len(filled)
            lists: list = [None] * len(filled)
            for i, r in enumerate(some):
                sketches[r], lists[r] = small[i].tobytes(), bands[i].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(code[:, 0].view(np.int64), mask=~filled),
                    pa.array(code[:, 1].view(np.int64), mask=~filled),
                    pa.array(lists, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                ["doc_id", "d0", "d1", "bands", "sketch"],
            )

    return sketch


def _verifier(common: tuple[np.ndarray, np.ndarray], similarity: float):
    """Similarity of each member to the representative that precedes it."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, keys, weights = None, None, None
        for batch in slices(batches):
            bags = Bags(Words(batch.column("text")), common)
            totals = np.add.reduceat(np.append(bags.weights, 0.0), bags.bounds[:-1])
            a_out, b_out = [], []
            groups = zip(*(batch.column(c).to_pylist() for c in ("a", "chunk", "is_member", "doc_id")))
            for i, (a, chunk, is_member, doc_id) in enumerate(groups):
                own = slice(bags.bounds[i], bags.bounds[i + 1])
                if not is_member:
                    leader, keys, weights = (a, chunk), bags.keys[own].copy(), bags.weights[own].copy()
                    continue
                if leader != (a, chunk) or not len(keys) or own.start == own.stop:
                    continue
                at = np.minimum(np.searchsorted(keys, bags.keys[own]), len(keys) - 1)
                both = keys[at] == bags.keys[own]
                shared = np.minimum(weights[at], bags.weights[own])[both].sum()
                if shared >= similarity * (weights.sum() + totals[i] - shared) * (1 - 1e-12):
                    a_out.append(a)
                    b_out.append(doc_id)
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], ["a", "b"])

    return verify


def verified(pairs: DataFrame, rows: DataFrame, common, similarity: float) -> DataFrame:
    """Of the pairs (a, b) of doc_id, those whose weighted Jaccard similarity suffices.

    Each text is sent once for each representative it is compared with. The
    members of one representative are dealt to as many tasks as they need.
    """
    sized = pairs.join(
        pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")), "a"
    )
    members = sized.select(
        F.col("b").alias("id"), "a", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int").alias("chunk"), F.lit(1).alias("is_member")
    )
    leaders = (
        sized.select("a", "chunks").distinct()
        .select(F.col("a").alias("id"), "a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(0).alias("is_member"))
    )
    texts = members.unionByName(leaders).join(rows, F.col("id") == F.col("doc_id"))
    return (
        texts.select("a", "chunk", "is_member", "doc_id", "text")
        .repartition("a", "chunk")
        .sortWithinPartitions("a", "chunk", "is_member", "doc_id")
        .mapInArrow(_verifier(common, similarity), "a BIGINT, b BIGINT")
        .distinct()
    )


def _blocks(frames: Iterator, columns: list[str]) -> Iterator[tuple[bool, dict]]:
    """(whether two blocks meet, columns of their members) from sorted frames."""
    import pandas as pd

    group, held = None, []
    for frame in frames:
        for key, part in frame.groupby(["band", "key", "low", "high"], sort=False):
            if key != group:
                if held:
                    yield group[2] != group[3], pd.concat(held)[columns]
                group, held = key, []
            held.append(part)
    if held:
        yield group[2] != group[3], pd.concat(held)[columns]


def _others(block, across: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per member, the others of a different class, and the share of samples that agree."""
    codes = np.frombuffer(b"".join(block["sketch"]), "<u4").reshape(len(block), -1)
    roots, sides = block["root"].to_numpy(), block["chunk"].to_numpy()
    for i in range(len(block)):
        fits = roots != roots[i]
        if across:
            fits &= sides != sides[i]
        at = np.flatnonzero(fits)
        if len(at):
            yield i, at, (codes[at] == codes[i]).mean(1)


def _nearest(frames):
    """Each member of a block with the one of another class that agrees with it most."""
    import pandas as pd

    for across, block in _blocks(frames, ["rep", "sketch", "root", "chunk"]):
        ids = block["rep"].to_numpy()
        out = {tuple(sorted((ids[i], ids[at[agreed.argmax()]]))) for i, at, agreed in _others(block, across)}
        yield pd.DataFrame(sorted(out), columns=["a", "b"]).astype("int64")


def _bags_of(texts: list[str], common: tuple[np.ndarray, np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Shingles and weights of each text, worked out a slice at a time."""
    out = []
    for part in slices([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])]):
        bags = Bags(Words(part.column("text")), common)
        for a, z in zip(bags.bounds[:-1], bags.bounds[1:]):
            out.append((bags.keys[a:z].copy(), bags.weights[a:z].copy()))
    return out


def _linker(common: tuple[np.ndarray, np.ndarray], similarity: float):
    """Verified links that join the classes of a block, at most one for each member.

    All pairs of different classes are looked at, but for those that the links
    found so far have joined already.
    """

    def link(frames):
        import pandas as pd

        for across, block in _blocks(frames, ["rep", "sketch", "root", "chunk", "text"]):
            ids, roots = block["rep"].to_numpy(), block["root"].to_numpy()
            joined = {r: r for r in roots}

            def find(r, joined=joined):
                while joined[r] != r:
                    joined[r] = r = joined[joined[r]]
                return r

            bags, out = None, []
            for i, at, agreed in _others(block, across):
                at = at[agreed >= LEAST_AGREEMENT]
                for j in at[at > i]:
                    x, y = find(roots[i]), find(roots[j])
                    if x == y:
                        continue
                    bags = bags or _bags_of(block["text"].tolist(), common)
                    (keys, weights), (others, theirs) = bags[i], bags[j]
                    place = np.minimum(np.searchsorted(keys, others), len(keys) - 1)
                    both = keys[place] == others
                    shared = np.minimum(weights[place], theirs)[both].sum()
                    if shared >= similarity * (weights.sum() + theirs.sum() - shared) * (1 - 1e-12):
                        joined[x] = y
                        out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
            yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return link


def _split_buckets(reps: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that hold several classes, with their class."""
    members = (
        reps.select("rep", "sketch", F.posexplode("bands").alias("band", "key"))
        .join(roots, F.col("rep") == F.col("node"), "left")
        .select("rep", "sketch", "band", "key", F.coalesce("root", "rep").alias("root"))
    )
    split = (
        members.groupBy("band", "key")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"))
        .where("low <> high")
        .select("band", "key", F.ceil(F.col("n") / BLOCK).cast("int").alias("chunks"))
    )
    return members.join(split, ["band", "key"])


def _in_blocks(members: DataFrame) -> DataFrame:
    """Members of each bucket in blocks of about ``BLOCK``, every two of which meet.

    So no bucket is too large for a task, and none is left out.
    """
    dealt = members.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    blocks = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return (
        blocks.withColumn("low", F.least("chunk", "other"))
        .withColumn("high", F.greatest("chunk", "other"))
        .drop("chunks", "other")
        .repartition("band", "key", "low", "high")
        .sortWithinPartitions("band", "key", "low", "high", "rep")
    )


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) with further links. What is known is a star for each class, so few rounds are left."""
    if links.isEmpty():
        return roots
    stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return stored(components(stars.unionByName(links)), "roots")


def _classes(rows: DataFrame, similarity: float) -> DataFrame:
    """doc_id and class_id of rows (doc_id, text) whose ids differ, null ones aside."""
    common = common_shingles(rows)
    sketches = stored(
        rows.mapInArrow(_sketcher(common), "doc_id BIGINT, d0 BIGINT, d1 BIGINT, bands ARRAY<BIGINT>, sketch BINARY"),
        "sketches",
    )
    named = sketches.where("doc_id IS NOT NULL AND d0 IS NOT NULL")
    reps = stored(
        named.groupBy("d0", "d1").agg(
            F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
        ),
        "texts",
    )
    banded = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    leaders = banded.groupBy("band", "key").agg(F.min("rep").alias("a"), F.count("*").alias("n")).where("n > 1")
    pairs = stored(
        banded.join(leaders, ["band", "key"]).where("rep <> a").select("a", F.col("rep").alias("b")).distinct(), "pairs"
    )
    # The texts are moved once; from here on only those of candidates are.
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = stored(
        rows.join(ids.hint("merge"), F.col("doc_id") == F.col("id"), "left_semi").dropDuplicates(["doc_id"]), "candidates"
    )
    links = stored(verified(pairs, texts, common, similarity), "verified")
    roots = stored(components(links), "roots")
    near = _in_blocks(_split_buckets(reps, roots)).mapInPandas(_nearest, "a BIGINT, b BIGINT").distinct()
    near = stored(near.join(pairs, ["a", "b"], "left_anti"), "pairs")
    roots = _joined(roots, stored(verified(near, texts, common, similarity), "verified"))
    # What is still in different classes is verified where the bucket's members meet.
    members = _split_buckets(reps, roots).join(texts, F.col("rep") == F.col("doc_id")).drop("doc_id")
    more = _in_blocks(members).mapInPandas(_linker(common, similarity), "a BIGINT, b BIGINT")
    roots = _joined(roots, stored(more.distinct(), "verified"))
    classes = reps.join(roots, F.col("rep") == F.col("node"), "left").select(
        "d0", "d1", F.coalesce("root", "rep").alias("class_id")
    )
    return sketches.select("doc_id", "d0", "d1").join(classes, ["d0", "d1"], "left").select(
        "doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id")
    )


def _numbered(rows: DataFrame) -> DataFrame | None:
    """Rows with a number of their own, if ids repeat; none if ids will do.

    Numbers go by doc_id, so the least one of a class has its least id. They are
    written once: every reading gives a row the same one. Rows without id have none.
    """
    twice = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    if twice.isEmpty():
        return None
    # A hot id is spread over tasks by its texts, and equal rows by where they were read.
    ordered = rows.withColumn("at", F.monotonically_increasing_id()).orderBy("doc_id", F.xxhash64("text"), "at")
    number = F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())
    return stored(ordered.drop("at").withColumn("number", number), "numbered")


def near_duplicates(docs: DataFrame, column: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id and class_id, the least doc_id of its class.

    Equal texts (the same words, whatever the case of A to Z) are one node. In
    each bucket every node is verified against the least one, then against the
    most alike of another class, and at last all pairs of a bucket that are still
    in different classes are verified where they meet. So classes are those of
    all links that a bucket shows. A text without words is a class of its own, a
    row without doc_id has none (null). Rows of one doc_id are judged each by its
    own text. Columns other than doc_id and the text are not read.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(column).alias("text"))
    numbered = _numbered(rows)
    if numbered is None:
        return _classes(rows, similarity)
    found = _classes(numbered.select(F.col("number").alias("doc_id"), "text"), similarity)
    ids = numbered.select("number", "doc_id")
    named = found.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("number"), "class_id").join(ids, "number")
    least = ids.select(F.col("number").alias("class_id"), F.col("doc_id").alias("least"))
    nameless = ids.where("number IS NULL").select("doc_id", F.lit(None).cast("bigint").alias("class_id"))
    return named.join(least, "class_id").select("doc_id", F.col("least").alias("class_id")).unionByName(nameless)


def drop_near_duplicates(docs: DataFrame, column: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class, one of least doc_id; all columns stay.

    Rows without doc_id stay. Of rows of one doc_id with different texts each
    belongs to the class of its own text; of equal rows one stays.
    """
    rows = docs.select(
        F.struct("*").alias("row"), docs["doc_id"].cast("bigint").alias("doc_id"), docs[column].alias("text")
    )
    numbered = _numbered(rows)
    if numbered is not None:
        rows = numbered.select("row", F.col("number").alias("doc_id"), "text")
    found = _classes(rows.select("doc_id", "text"), similarity)
    dropped = found.where("class_id <> doc_id").select(F.col("doc_id").alias("dropped"))
    kept = rows.join(dropped, F.col("doc_id") == F.col("dropped"), "left_anti")
    return kept.select("row.*")
