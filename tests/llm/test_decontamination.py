import random
import re
import time

import numpy as np
import pytest
from conftest_llm import prose
from hypothesis import given, settings
from hypothesis import strategies as st

from rollcall.llm import decontamination as D
from rollcall.llm.catalogue import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def items(spark):
    def build(texts):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame(pairs, "item_id BIGINT, text STRING")

    return build


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]+", "", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def found(df):
    return {(r.doc_id, r.item_id) for r in df.collect()}


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab", max_size=14), st.text(alphabet="ab", max_size=14), st.integers(0, 6))
def test_banded_distance(a, b, most):
    codes = [np.frombuffer(x.encode(), np.uint8) for x in (a, b)]
    assert D.banded_distance(*codes, most) == min(levenshtein(a, b), most + 1)


def test_query_finds_all_whole_items_and_no_others(spark, con):
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    bench = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    exact = {(i, j) for i, t in docs for j, x in bench if squeezed(x) in squeezed(t)}
    assert exact and found(QUERIES["op6_benchmark_decontamination"](spark, SF_DIR)) == exact


def edit(text, rate, seed):
    rng = random.Random(seed)
    out = list(text)
    for i in sorted(rng.sample(range(len(out)), int(rate * len(out))), reverse=True):
        kind = rng.randrange(3)
        if kind == 0:
            out[i] = "q"
        elif kind == 1:
            out.insert(i, "q")
        else:
            del out[i]
    return "".join(out)


def test_edited_and_partial_items(make_docs, items):
    bench = [prose(60, s) for s in range(30)]
    docs, wanted = [], set()
    for n, item in enumerate(bench):
        words = item.split()
        kinds = [item, edit(item, 0.02, n), edit(item, 0.035, n), " ".join(words[: len(words) * 2 // 3]), item.upper().replace(" ", "\n")]
        docs.append(f"{prose(200, 100 + n)} {kinds[n % 5]} {prose(100, 200 + n)}")
        wanted.add((n, n))
    docs += [prose(400, 300 + n) for n in range(20)]
    # A third of an item is no leak.
    docs.append(f"{prose(50, 400)} {' '.join(bench[0].split()[:18])} {prose(50, 401)}")
    assert found(D.leaks(make_docs(docs), items(bench))) == wanted


def test_results_are_true_alignments(make_docs, items):
    bench = [prose(50, s) for s in range(8)]
    docs = [f"{prose(30, 50 + n)} {edit(x, 0.03, n)} {prose(30, 70 + n)}" for n, x in enumerate(bench)]
    rows = D.leaks(make_docs(docs), items(bench)).collect()
    assert len(rows) == 8
    for r in rows:
        a = squeezed(bench[r.item_id])[r.item_start : r.item_start + r.item_length]
        b = squeezed(docs[r.doc_id])[r.start : r.start + r.length]
        assert levenshtein(a, b) == r.edits <= D.EDITS * r.item_length


def test_blocks_of_a_large_benchmark(make_docs, items, monkeypatch):
    bench = [prose(40, s) for s in range(20)]
    docs = [f"{prose(30, 50)} {bench[n]}" for n in range(20)]
    monkeypatch.setattr(D, "BLOCK_BYTES", 700)
    assert found(D.leaks(make_docs(docs), items(bench))) == {(n, n) for n in range(20)}


def test_hard_rows(make_docs, items):
    item = prose(40, 1)
    docs = [(None, item), (1, item), (1, item), (2, None), (3, ""), (4, "x" * 500_000 + " " + item + " y"), (5, item[:8])]
    bench = items([(7, item), (7, item), (None, item), (8, None), (9, ""), (10, "short")])
    rows = D.leaks(make_docs(docs).withColumnRenamed("source", "item_id"), bench).collect()
    assert sorted(((r.doc_id, r.item_id) for r in rows), key=repr) == sorted([(None, 7), (1, 7), (1, 7), (4, 7)], key=repr)
    left = D.drop_leaks(make_docs(docs), bench)
    assert sorted((r.doc_id for r in left.collect()), key=repr) == [2, 3, 5, None]


def test_rows_are_judged_by_their_own_text_and_keep_all_columns(make_docs, items):
    item, clean = prose(40, 1), prose(60, 2)
    docs = make_docs([(1, f"x {item} y"), (1, clean), (2, clean), (2, None)])
    for name in ("__leak", "item_id", "row"):
        left = D.drop_leaks(docs.withColumnRenamed("source", name), items([item]))
        assert left.columns == ["doc_id", "text", "lang", name, "n_chars"]
        assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(
            [(1, clean), (2, clean), (2, None)], key=repr
        )


def test_long_repetitions_take_no_time_and_lose_nothing(make_docs, items):
    rule, table = "-" * 200, "|---" * 40
    bench = [f"{prose(30, 3)} {rule} {prose(30, 4)}", f"{table} {prose(40, 5)}", rule]
    parts = ["-" * 1_000_000, "|---" * 100_000]
    docs = [
        parts[0],
        parts[1],
        f"{parts[0]} {bench[0]}",
        f"{bench[1]} {parts[1]}",
        parts[0] + prose(30, 4) + prose(30, 9),
        "-" * 150,
        "-" * 201,
    ] + ["-" * 60] * 40
    begun = time.perf_counter()
    found = {(r.doc_id, r.item_id) for r in D.leaks(make_docs(docs), items(bench)).collect()}
    assert time.perf_counter() - begun < 60
    assert {(0, 2), (2, 0), (2, 2), (3, 1), (4, 2), (5, 2), (6, 2)} <= found
    assert (1, 0) not in found and not {i for i, _ in found} & set(range(7, 47))


def test_empty_tables(make_docs, items):
    assert D.leaks(make_docs([]), items([prose(40, 1)])).collect() == []
    assert D.leaks(make_docs([prose(40, 1)]), items([])).collect() == []
    assert D.drop_leaks(make_docs(["a"]), items([])).count() == 1


def holds(item, text):
    """Brute force: whether some stretch of the item aligns within its edits anywhere in the text."""
    n = len(item)
    for q in range(n - D.least_cover(n) + 1):
        row = [0] * (len(text) + 1)
        for m, x in enumerate(item[q:], 1):
            above, row = row, [m]
            for j, y in enumerate(text, 1):
                row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
            if m >= D.least_cover(n) and min(row) <= int(D.EDITS * m):
                return True
    return False


def changed(text, places):
    return "".join("#" if i in places else c for i, c in enumerate(text))


def test_edits_at_the_ends_and_short_items(make_docs, items):
    rng = random.Random(5)
    bench, docs = [], []
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    sizes = [1, 5, 9, 10, 16, 17, 18, 19, 20, 33, 34, 40, 45, 60, 67, 90] * 3
    for k, n in enumerate(sizes):
        item = "".join(rng.choice(letters) for _ in range(n))
        if n == 1:
            item = "=~@"[k // 16]
        most = int(D.EDITS * n)
        places = [set(rng.sample(range(n), most)), set(range(1, n, 9)[:most]), set(range(n - 1, 0, -9)[:most])][k // 16]
        noise = "".join(rng.choice(letters) for _ in range(30))
        bench.append(item)
        docs.append(f"{noise}{changed(item, places)}{noise[::-1]}")
    bench += [prose(10, 70)[:40], "".join(rng.choice(letters) for _ in range(67))]
    docs += [changed(squeezed(bench[-2]), {3}), changed(bench[-1], {9, 19, 47, 57})]
    docs += [changed(docs[n], set(range(30, 90, 4))) for n in range(40)]
    wanted = {
        (i, j) for i, t in enumerate(docs) for j, x in enumerate(bench) if holds(squeezed(x), squeezed(t))
    }
    assert {(i, i) for i in range(len(bench))} <= wanted
    rows = D.leaks(make_docs(docs), items(bench)).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == wanted
    for r in rows:
        a = squeezed(bench[r.item_id])[r.item_start : r.item_start + r.item_length]
        b = squeezed(docs[r.doc_id])[r.start : r.start + r.length]
        assert levenshtein(a, b) == r.edits <= D.EDITS * r.item_length
