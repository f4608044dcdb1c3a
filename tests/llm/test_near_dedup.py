import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import prose, words_of

from rollcall.llm import near_dedup
from rollcall.llm.catalogue import QUERIES
from rollcall.llm.components import components
from rollcall.llm.texts import Words


def bag(text):
    words = words_of(text)
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_force(docs, similarity=0.8):
    """Classes of all pairs at or above the similarity, by their least doc_id."""
    docs = [(i, bag(t)) for i, t in docs]
    df = Counter(x for _, b in docs for x in b)
    idf = {x: 1 + 0.5 * min(1, math.log(len(docs) / n) / math.log(100)) for x, n in df.items()}
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for n, (_, b) in enumerate(docs):
        for x in b:
            holders.setdefault(x, []).append(n)
    seen = set()
    for own in holders.values():
        for a in own:
            for b in own:
                if a < b and (a, b) not in seen:
                    seen.add((a, b))
                    (i, x), (j, y) = docs[a], docs[b]
                    shared = sum(n * idf[k] for k, n in (x & y).items())
                    if shared >= similarity * sum(n * idf[k] for k, n in (x | y).items()) * (1 - 1e-12):
                        low, high = sorted((find(i), find(j)))
                        root[high] = low
    return {i: find(i) for i, _ in docs}


def classes(df):
    return {r.doc_id: r.class_id for r in df.collect()}


def test_query_matches_brute_force(spark, con):
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    got = classes(QUERIES["op2_minhash_near_dedup"](spark, "/root/testdata/sf0.001"))
    assert got == brute_force(docs)


def edited(text, changes, seed):
    words = text.split()
    rng = random.Random(seed)
    for i in rng.sample(range(len(words)), changes):
        words[i] = f"changed{seed}x{i}"
    return " ".join(words)


def test_groups_of_copies_and_near_copies(make_docs):
    base = prose(300, 1)
    texts = [base] * 40 + [edited(base, 3, s) for s in range(30)] + [prose(300, 100 + s) for s in range(20)]
    texts += [None, "", " \n", "two words", "Two  WORDS", "other words", prose(60_000, 7)]
    got = classes(near_dedup.near_duplicates(make_docs(texts)))
    known = [(i, t) for i, t in enumerate(texts)]
    assert got == brute_force(known)
    assert {got[i] for i in range(70)} == {0}
    assert [got[i] for i in (90, 91, 92)] == [90, 91, 92]


def test_chains_are_one_class(make_docs):
    text = prose(400, 2)
    chain = [text]
    for s in range(12):
        chain.append(edited(chain[-1], 4, 50 + s))
    got = classes(near_dedup.near_duplicates(make_docs(chain)))
    assert got == brute_force(list(enumerate(chain)))
    assert len(set(got.values())) < len(chain)


def test_boilerplate_links_nothing(make_docs):
    line = prose(20, 3)
    texts = [f"{prose(120, 200 + s)} {line}" for s in range(60)]
    assert classes(near_dedup.near_duplicates(make_docs(texts))) == {i: i for i in range(60)}


def test_null_and_repeated_ids(make_docs):
    text = prose(80, 4)
    rows = [(None, text), (5, text), (5, text), (3, text), (8, prose(80, 5)), (8, prose(80, 5))]
    got = sorted(((r.doc_id, r.class_id) for r in near_dedup.near_duplicates(make_docs(rows)).collect()), key=repr)
    assert got == sorted([(None, None), (5, 3), (5, 3), (3, 3), (8, 8), (8, 8)], key=repr)
    kept = near_dedup.drop_near_duplicates(make_docs(rows).withColumnRenamed("source", "class_id"))
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [3, 8, None]
    assert kept.columns == ["doc_id", "text", "lang", "class_id", "n_chars"]


def test_rows_of_one_id_are_judged_by_their_own_text(spark, make_docs):
    a, b, c = prose(80, 31), prose(80, 32), prose(80, 33)
    rows = [(1, a), (1, b), (2, a), (3, c), (3, c), (4, b), (None, a), (0, None), (0, "")]
    got = sorted(((r.doc_id, r.class_id) for r in near_dedup.near_duplicates(make_docs(rows)).collect()), key=repr)
    assert got == sorted([(1, 1), (1, 1), (2, 1), (3, 3), (3, 3), (4, 1), (None, None), (0, 0), (0, 0)], key=repr)
    kept = near_dedup.drop_near_duplicates(make_docs(rows))
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(left, key=repr) == sorted([(1, a), (1, b), (3, c), (None, a), (0, None), (0, "")], key=repr)


def test_columns_of_any_name_stay(make_docs):
    text = prose(80, 34)
    for ids in ([1, 2, 3], [1, 1, 3]):
        docs = make_docs(list(zip(ids, [text, text, prose(80, 35)])))
        for name in ("__dropped", "row", "number"):
            kept = near_dedup.drop_near_duplicates(docs.withColumnRenamed("source", name))
            assert kept.columns == ["doc_id", "text", "lang", name, "n_chars"]
            assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_empty_table(make_docs):
    assert near_dedup.near_duplicates(make_docs([])).collect() == []
    assert near_dedup.drop_near_duplicates(make_docs([])).collect() == []


@pytest.mark.parametrize("changes", [2, 6, 12])
def test_samples_agree_as_often_as_bags_do(changes):
    none = (np.zeros(0, np.uint64), np.zeros(0))
    agreed, true = [], []
    for s in range(60):
        a = prose(150, 1000 + s)
        b = edited(a, changes, s)
        bags = near_dedup.Bags(Words(pa.array([a, b])), none)
        x = near_dedup.samples(bags)
        agreed.append((x[0] == x[1]).mean())
        i, j = bag(a), bag(b)
        true.append(sum((i & j).values()) / sum((i | j).values()))
    assert abs(np.mean(agreed) - np.mean(true)) < 0.03


def test_weights_count_in_samples():
    # One shared shingle of nearly all the weight: samples agree nearly always.
    common = " ".join(["a b c d e"] * 60)
    none = (np.zeros(0, np.uint64), np.zeros(0))
    bags = near_dedup.Bags(Words(pa.array([f"{common} x y z", f"{common} u v w"])), none)
    x = near_dedup.samples(bags)
    assert (x[0] == x[1]).mean() > 0.75


def test_common_shingles_are_exact(spark, make_docs):
    line = "five words make a shingle"
    texts = [line if s % 3 else prose(9, s) for s in range(300)]
    keys, weights = near_dedup.common_shingles(make_docs(texts))
    share = 200 / 300
    expected = 1 + 0.5 * math.log(1 / share) / math.log(100)
    assert len(keys) == 1 and weights[0] == pytest.approx(expected)


def test_blocks_of_a_bucket_leave_no_pair_out(make_docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "CHUNK", 2)
    base = prose(200, 9)
    texts = [edited(base, n % 14, n) for n in range(40)]
    assert classes(near_dedup.near_duplicates(make_docs(texts))) == brute_force(list(enumerate(texts)))


def test_components_of_long_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a BIGINT, b BIGINT")).collect() == []
