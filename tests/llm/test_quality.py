from collections import Counter

from conftest_llm import prose, words_of

from rollcall.llm import quality
from rollcall.llm.catalogue import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def measures(text):
    words = words_of(text, lower=False)
    text = text or ""
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if count[w] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if words_of(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def verdicts(rows):
    return {r.doc_id: tuple(r)[1:6] for r in rows}


def test_measures_on_hard_texts(make_docs):
    texts = [
        None,
        "",
        " \n\t\n ",
        "one two three four",
        "a b c d e a b c d e",
        "a a a a a a a a a a a a",
        "é🙂   x\x1cy " * 6,
        "line\nline\n\nline \nother",
        "# * $ % & | < > ** plain",
        prose(30_000, 1),
        prose(200, 2) + " " + prose(200, 2) + "\n" + prose(200, 2),
    ]
    assert verdicts(quality.report(make_docs(texts)).collect()) == {i: measures(t) for i, t in enumerate(texts)}


def test_query_matches_brute_force(spark, con):
    rows = QUERIES["op9_quality_rules"](spark, SF_DIR).collect()
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    assert verdicts(rows) == {i: measures(t) for i, t in docs}
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_clean_documents_stay_and_most_junk_goes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.report(docs).join(labels, "doc_id").collect()
    junk = [r for r in rows if r.quality == 0]
    clean = [r for r in rows if r.quality == 1 and not r.base_failed]
    assert all(r.kept for r in clean)
    assert sum(not r.kept for r in junk) > 0.9 * len(junk)


def test_filter_keeps_columns_and_whole_rows(spark):
    schema = "doc_id BIGINT, text STRING, n_words STRING, failed_bits STRING, __ledger STRING"
    good = prose(60, 5)
    rows = [(1, good, "x", "y", "z"), (1, good, "x", "y", "z"), (None, good, None, None, None), (2, None, "a", "b", "c")]
    kept = quality.filter_documents(spark.createDataFrame(rows, schema))
    assert kept.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(rows[:3], key=repr)
    assert quality.filter_documents(spark.createDataFrame([], schema)).collect() == []


def test_policies_and_ablations_need_only_the_bits(make_docs):
    texts = ["few words", "a b c d e a b c d e f g", prose(50, 1), "x# y# z# " * 9 + prose(5, 2)]
    rows = quality.ledger(make_docs(texts))
    for policy in quality.POLICIES:
        mask = quality.policy_mask(policy)
        bits = [r.failed_bits & mask for r in rows.collect()]
        got = {r.rule: (r.failed, r.only_this) for r in quality.ablations(rows, policy).collect()}
        assert got == {
            n: (sum(b & quality.BITS[n] != 0 for b in bits), sum(b == quality.BITS[n] for b in bits))
            for n in quality.POLICIES[policy]
        }
    empty = quality.ablations(quality.ledger(make_docs([]))).collect()
    assert {(r.failed, r.only_this) for r in empty} == {(0, 0)}


def test_no_python_in_the_plan(make_docs):
    plan = quality.report(make_docs(["a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
