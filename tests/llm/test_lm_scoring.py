import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import prose, words_of
from pyspark.sql import functions as F

from rollcall.llm import lm_scoring as L
from rollcall.llm.catalogue import QUERIES

END, BEGIN, RARE = "</s>", "<s>", "<rare>"


class BruteForce:
    """The model of the operator with dictionaries."""

    def __init__(self, texts, vocabulary=L.VOCABULARY):
        chains = [words_of(t) + [END] for t in texts]
        self.counts = Counter(x for c in chains for x in c)
        self.tokens, self.types = sum(self.counts.values()), len(self.counts)
        self.total = self.tokens + self.types + 1
        words = sorted((w for w in self.counts if w != END), key=lambda w: -self.counts[w])
        self.frequent = set(words[:vocabulary]) | {END}
        self.pairs = Counter()
        for c in chains:
            self.pairs.update(zip([BEGIN, *map(self.name, c[:-1])], map(self.name, c)))
        self.history = Counter()
        for (h, _), n in self.pairs.items():
            self.history[h] += n
        of = Counter(self.pairs.values())
        self.discount = L.discounts(of)
        self.lower = {w: (self.counts[w] + 1) / self.total for w in self.frequent}
        if END not in self.counts:
            self.lower[END] = 1 / self.total
        self.lower[RARE] = 1 - sum(self.lower.values())
        self.backoff, self.scale = {}, {}
        for h in self.history:
            own = {w: n for (g, w), n in self.pairs.items() if g == h}
            seen = sum(self.kept(n) for n in own.values()) / self.history[h]
            below = sum(self.lower[w] for w in own)
            factor = self.history[h] / (self.history[h] + 1) / seen if 1 - seen < 1e-9 else 1
            full = 1 - below < 1e-12  # nothing to back off to
            self.scale[h] = 1 / seen if full else factor
            self.backoff[h] = 0.0 if full else (1 - factor * seen) / (1 - below)

    def name(self, word):
        return word if word in self.frequent else RARE

    def kept(self, n):
        return n * (self.discount[n] if n <= L.DISCOUNTED else 1)

    def base(self, word):
        return (self.counts[word] + 1) / self.total

    def of_class(self, h, w):
        n = self.pairs[h, w]
        if n:
            return self.scale[h] * self.kept(n) / self.history[h]
        return self.backoff.get(h, 1.0) * self.lower[w]

    def probability(self, before, word):
        h, w = before if before == BEGIN else self.name(before), self.name(word)
        p = self.of_class(h, w)
        return p * self.base(word) / self.lower[RARE] if w == RARE else p

    def score(self, text):
        chain = words_of(text) + [END]
        return (
            len(chain),
            sum(self.counts[w] > 0 for w in chain),
            sum(math.log10(self.base(w)) for w in chain),
            sum(math.log10(self.probability(b, w)) for b, w in zip([BEGIN, *chain], chain)),
        )


def check(rows, expected, tokens):
    assert len(rows) == len(expected)
    rows = sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id, r.held_out, r.score))
    expected = sorted(expected, key=lambda e: (e[0] is None, e[0], e[1], e[2][3]))
    for r, (doc_id, held, (n, known, base, score)) in zip(rows, expected):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (doc_id, held, n, known, tokens)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def test_query_matches_brute_force(spark, con):
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs}
    model = BruteForce([t for i, t in docs if not held[i]])
    rows = QUERIES["op5_lm_scoring"](spark, "/root/testdata/sf0.001").collect()
    check(rows, [(i, held[i], model.score(t)) for i, t in docs], model.tokens)
    # On texts it has not seen the model beats the unigrams.
    mine = [r for r in rows if r.held_out]
    assert sum(r.score for r in mine) > sum(r.base_score for r in mine)


TEXTS = [prose(60, s, 12) for s in range(12)] + [None, "", "A b A b", "a B", "x " * 40]


@pytest.mark.parametrize("vocabulary", [0, 5, 1000])
def test_small_vocabularies_and_hard_texts(make_docs, vocabulary):
    rows = [*enumerate(TEXTS), (None, "a b"), (3, "other"), (50, "a b"), (50, "a b")]
    split = make_docs(rows).withColumn("held_out", F.coalesce(F.col("doc_id") % 4 == 2, F.lit(False)))
    training = [t for i, t in rows if i is None or i % 4 != 2]
    model = BruteForce(training, vocabulary)
    if vocabulary == 5:  # ties of frequency are broken by hash: take the operator's words
        got = L.score_documents(split, vocabulary).collect()
        assert len(got) == len(rows)
        assert {(r.n_tokens, r.n_known) for r in got} == {model.score(t)[:2] for _, t in rows}
        return
    got = L.score_documents(split, vocabulary).collect()
    check(got, [(i, i is not None and i % 4 == 2, model.score(t)) for i, t in rows], model.tokens)


def test_every_distribution_sums_to_one():
    model = BruteForce(TEXTS, 20)
    for h in model.history:
        assert sum(model.of_class(h, w) for w in model.lower) == pytest.approx(1)
    rare = [w for w in model.counts if w not in model.frequent]
    assert sum(model.base(w) for w in rare) + 1 / model.total == pytest.approx(model.lower[RARE])


def test_discounts():
    plain = [1.0, 0.5, 0.75, 1 - 0.5 / 3, 1 - 0.5 / 4, 0.9]
    assert L.discounts({}).tolist() == pytest.approx(plain)
    assert L.discounts({1: 1, 6: 9}).tolist() == pytest.approx(plain)
    found = L.discounts({1: 1000, 2: 300, 3: 140, 4: 80, 5: 50, 6: 35})
    n = [0, 1000, 300, 140, 80, 50, 35]
    most = 6 * n[6] / n[1]
    for r in range(1, 6):
        assert found[r] == pytest.approx(((r + 1) * n[r + 1] / (r * n[r]) - most) / (1 - most))


def test_nothing_to_learn_from(make_docs):
    split = make_docs(["a b", None]).withColumn("held_out", F.lit(True))
    rows = {r.doc_id: r for r in L.score_documents(split).collect()}
    assert (rows[0].n_tokens, rows[0].n_known, rows[0].train_tokens, rows[0].base_score) == (3, 0, 0, 0.0)
    empty = make_docs([]).withColumn("held_out", F.lit(False))
    assert L.score_documents(empty).collect() == []


def test_packed_numbers():
    values = np.array([0, 1, 1, 300, 2**40, 2**63 + 5], np.uint64)
    assert L._unpack(L._pack(values)).tolist() == values.tolist()
    assert L._unpack_small(L._pack_small(np.array([0, 1, 70_000]))).tolist() == [0, 1, 70_000]
    assert len(L._unpack(L._pack(values[:0]))) == 0


def test_flushes_and_buckets_change_nothing(make_docs, monkeypatch):
    split = make_docs(list(enumerate(TEXTS))).withColumn("held_out", F.col("doc_id") % 3 == 1)
    model = BruteForce([t for i, t in enumerate(TEXTS) if i % 3 != 1])
    monkeypatch.setattr(L, "BUCKET_BYTES", 300)
    for hot in (0, 7, 1 << 19):
        monkeypatch.setattr(L, "HOT_PAIRS", hot)
        rows = L.score_documents(split).collect()
        check(rows, [(i, i % 3 == 1, model.score(t)) for i, t in enumerate(TEXTS)], model.tokens)


def test_tables_in_several_rows(monkeypatch):
    """A bucket's table comes in several rows, in any order, before those that ask it."""
    monkeypatch.setattr(L, "ROW_KEYS", 5)
    keys, counts = np.arange(3, 45, 3, dtype=np.uint64), np.arange(1, 15)
    known = [b.to_pylist()[0] for b in L._table_rows(L.UNIGRAM, 4, keys, counts)]
    assert [len(L._unpack(r["keys"])) for r in known] == [5, 5, 4]
    words = np.array([3, 4, 18, 42], np.uint64)
    unigrams = L.Unigrams(np.zeros(0, np.uint64), np.zeros(0, np.int64), 105, 14, 0)
    asking = {"keys": L._pack(words), "counts": L._pack_small([1, 1, 1, 2]), "docs": L._pack_small([0, 1, 1, 2])}
    own = {"f0": 1, "f1": 2, "size": 3, "doc_ids": None, "held_out": None, "n_tokens": None, "known": None, "base": None, "score": None}
    rows = [r | {"kind": 0, "docs": None} | own for r in reversed(known)]
    rows.append({"space": L.UNIGRAM, "bucket": 4, "kind": 1} | asking | own)
    types = {"keys": pa.binary(), "counts": pa.binary(), "docs": pa.binary(), "known": pa.binary(), "base": pa.binary(), "score": pa.binary()}
    batch = pa.RecordBatch.from_pydict(
        {k: pa.array([r[k] for r in rows], types.get(k)) for k in rows[0]}
    )
    parts = (unigrams, np.ones(L.DISCOUNTED + 1), np.ones(3), np.ones(3))
    (answer,) = L._scorer(parts)(iter([batch]))
    assert np.frombuffer(answer.column("known")[0].as_py(), "<i8").tolist() == [1, 1, 2]
    expected = [math.log10(2 / 120), math.log10(1 / 120) + math.log10(7 / 120), 2 * math.log10(15 / 120)]
    assert np.frombuffer(answer.column("base")[0].as_py(), "<f8").tolist() == pytest.approx(expected)


def test_the_threshold_of_hot_pairs():
    assert L.hot_threshold({1: 100, 2: 10, 5: 3}, 13) == 2
    assert L.hot_threshold({1: 100, 2: 10, 5: 3}, 12) == 5
    assert L.hot_threshold({1: 100, 2: 10, 5: 3}, 1000) == 1
    assert L.hot_threshold({1: 100, -11: 4, -12: 2}, 5) == 4096
    assert L.hot_threshold({1: 5}, 4) > 1


@pytest.mark.parametrize("known", [0, 5, 60])
def test_words_that_tasks_do_not_know_have_bigrams_of_their_own(make_docs, monkeypatch, known):
    """However few words every task knows, the model is that of all words."""
    texts = [*TEXTS, "zz qq " * 9, "unheard of b0 zz qq", "zz only1 qq only2"]
    rows = [*enumerate(texts), (None, "a b"), (2, texts[2]), (50, "a b"), (50, "a b")]
    split = make_docs(rows).withColumn("held_out", F.coalesce(F.col("doc_id") % 4 == 2, F.lit(False)))
    model = BruteForce([t for i, t in rows if i is None or i % 4 != 2], None)
    assert len(model.counts) > 60
    monkeypatch.setattr(L, "KNOWN_WORDS", known, raising=False)
    monkeypatch.setattr(L, "BUCKET_BYTES", 300)
    for hot in (0, 1 << 19):
        monkeypatch.setattr(L, "HOT_PAIRS", hot)
        check(
            L.score_documents(split).collect(),
            [(i, i is not None and i % 4 == 2, model.score(t)) for i, t in rows],
            model.tokens,
        )


def test_more_words_than_tasks_know(make_docs):
    """Words beyond the 262,144 most frequent are scored by their own pairs."""
    common = " ".join(f"w{i} w{i}" for i in range(1 << 18))
    split = make_docs([common, " ".join(f"rare{i}" for i in range(12))]).withColumn("held_out", F.lit(False))
    rows = {r.doc_id: r for r in L.score_documents(split).collect()}
    # Each pair was seen once, after the begin in one of two texts: half an occurrence is taken off.
    assert (rows[1].n_known, rows[1].score) == (13, pytest.approx(12 * math.log10(0.5) + math.log10(0.5 / 2)))


def flush_batch(texts):
    return pa.RecordBatch.from_pydict(
        {"doc_id": list(range(len(texts))), "text": texts, "held_out": [False] * len(texts)}
    )


def test_words_are_summed_before_they_are_sent(monkeypatch):
    """A word is sent once for many flushes, not once a flush."""
    monkeypatch.setattr(L, "FLUSH_WORDS", 1)
    batches = [flush_batch(["a b a", None]), flush_batch(["b c"]), flush_batch([""])]
    for held, most in ((1 << 19, 3), (1, 4)):
        monkeypatch.setattr(L, "HELD_COUNTS", held, raising=False)
        sent = [r for b in L._count_words(iter(batches)) for r in b.to_pylist()]
        assert len(sent) == most
        found = Counter()
        for r in sent:
            found[r["word"]] += r["n"]
        assert sorted(found.values()) == [1, 2, 2]


def small_unigrams(known):
    words = np.sort(L.Words(pa.array([" ".join(known)])).hashes() | L._RARE)
    return L.Unigrams(words, np.full(len(words), 2), 1000, 200, 4, True)


def test_a_task_sends_few_batches():
    """What documents ask of many buckets goes to Spark together."""
    text = " ".join(f"w{i} v{i % 7} u{i * 5 % 11}" for i in range(200))
    unigrams = small_unigrams([f"w{i}" for i in range(100)] + [f"v{i}" for i in range(7)])
    no_hot = np.zeros(0, np.uint64), np.zeros(0)
    deal = L._occurrences(unigrams, 50, np.ones(len(unigrams.words) + 3), no_hot)
    batches = list(deal(iter([flush_batch([text, text, None])])))
    assert len(batches) == 1 and batches[0].num_rows > 100
    rows = [r for r in batches[0].to_pylist() if r["space"] >= 0]
    for r in rows:
        keys, docs = L._unpack(r["keys"]), L._unpack_small(r["docs"])
        assert len(keys) == len(docs) == len(L._unpack_small(r["counts"])) == len(set(zip(keys.tolist(), docs.tolist())))


def test_documents_without_a_hot_pair():
    """Hot pairs that no document of a flush has change nothing."""
    unigrams = small_unigrams(["a", "b"])
    ones = np.full(len(unigrams.words) + 3, 0.5)
    scores = []
    for hot in (np.zeros(0, np.uint64), np.array([1 << 39], np.uint64)):
        deal = L._occurrences(unigrams, 3, ones, (hot, np.zeros(len(hot))))
        rows = [r for b in deal(iter([flush_batch(["a rare b"])])) for r in b.to_pylist()]
        (own,) = [r for r in rows if r["space"] == -1]
        scores.append(np.frombuffer(own["score"], "<f8").tolist())
    assert scores[0] == scores[1] and scores[0][0] < 0


def test_known_words_are_found_whatever_their_prefix():
    prefix = np.uint64(0xABCDE << 44)
    words = np.sort(np.array([prefix + np.uint64(i << 21) for i in range(5)] + [1 << 20, (1 << 64) - 1], np.uint64))
    unigrams = L.Unigrams(words, np.ones(len(words), np.int64), 9, 9, 1)
    asked = np.concatenate([words[::-1], words + np.uint64(1), [prefix]]).astype(np.uint64)
    place = {int(w): i for i, w in enumerate(words)}
    assert unigrams.ids(asked).tolist() == [place.get(int(w), unigrams.unknown) for w in asked]
    none = L.Unigrams(words[:0], np.zeros(0, np.int64), 9, 9, 1)
    assert none.ids(asked).tolist() == [0] * len(asked)


def test_distinct_keys_by_document():
    rng = np.random.default_rng(5)
    keys, of = rng.integers(0, 40, 500).astype(np.uint64), np.sort(rng.integers(0, 6, 500))
    expected = sorted((k, d, n) for (k, d), n in Counter(zip(keys.tolist(), of.tolist())).items())
    assert list(zip(*(x.tolist() for x in L._known_pairs(keys, of)))) == expected
    found, at = L._distinct(keys, of)
    assert list(zip(*(x.tolist() for x in found))) == expected
    assert keys[at].tolist() == found[0].tolist() and of[at].tolist() == found[1].tolist()
    for docs in (of, of * 1000):
        present, place = L._present(docs[:50])
        assert present[place].tolist() == docs[:50].tolist() and len(set(place)) == len(present)


def test_flushes_dealt_together(monkeypatch):
    """With many buckets a task sends a row a bucket for several flushes, and all scores stay."""
    monkeypatch.setattr(L, "FLUSH_WORDS", 1)
    texts = [t for t in TEXTS if t] + [None, "a b", "a b"]
    batches = [flush_batch([t, "and a rare one"]) for t in texts]
    unigrams = small_unigrams(sorted({w for t in texts[:6] for w in words_of(t)}))
    model = unigrams, np.full(L.DISCOUNTED + 1, 0.5), np.full(len(unigrams.words) + 3, 0.5), np.ones(len(unigrams.words) + 3)
    hot = np.zeros(0, np.uint64), np.zeros(0)
    found, sent, counted = [], [], []
    for row_buckets in (64, 1):
        monkeypatch.setattr(L, "ROW_BUCKETS", row_buckets, raising=False)
        rows = pa.Table.from_batches(L._occurrences(unigrams, 6, model[2], hot)(iter(batches)))
        sent.append(rows.num_rows)
        rows = rows.sort_by([("space", "ascending"), ("bucket", "ascending")])
        parts = pa.Table.from_batches(L._scorer(model)(iter(rows.combine_chunks().to_batches())))
        parts = parts.sort_by([("f0", "ascending"), ("f1", "ascending")]).combine_chunks()
        scored = [r for b in L._gather(iter(parts.to_batches())) for r in b.to_pylist()]
        found.append(sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in scored))
        pairs = [r for b in L._count_pairs(unigrams, 6)(iter(batches)) for r in b.to_pylist()]
        counts = Counter()
        for r in pairs:
            counts.update(dict(zip(L._unpack(r["keys"]).tolist(), L._unpack_small(r["counts"]).tolist())))
        counted.append((len(pairs), counts))
    assert len(found[0]) == 2 * len(texts)
    assert all(a == pytest.approx(b, rel=1e-9) for a, b in zip(*found))
    assert 3 * sent[1] < sent[0] and 3 * counted[1][0] < counted[0][0] and counted[0][1] == counted[1][1]


def test_tasks_get_a_few_megabytes_at_a_time(spark, tmp_path):
    """Whatever a task reads, what lies in memory at once is bounded; the caller's session stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    text = "word " * 200_000
    docs = spark.range(12).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op5_lm_scoring"](spark, str(tmp_path))
    assert spark.conf.get(key, None) == before and found.count() == 12
    rows = found.sparkSession.read.parquet(f"{tmp_path}/documents.parquet").coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    assert max(r.n for r in rows.mapInArrow(sizes, "n BIGINT").collect()) <= L.TASK_BYTES + 2 * len(text)
