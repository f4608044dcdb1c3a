import corpus_pipeline as P
from conftest_llm import prose
from test_decontamination import squeezed
from test_near_dedup import brute_force as classes_of
from test_packing import check_packed, library, pieces_of  # noqa: F401
from test_quality import measures
from test_suffix_dedup import brute_force as spans_of
from test_suffix_dedup import cover, words_of

SF_DIR = "/root/testdata/sf0.001"


def test_each_stage_against_brute_force(spark, con, library, tmp_path):  # noqa: F811
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    bench = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    for name, stage in P.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            check_packed(docs.collect(), [p for i, t in before for p in pieces_of(library, i, t)])
            break
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        if name == "quality_rules":
            base = {i: measures(t) for i, t in before}
            assert not any(base[i][0] < 10 or 100 * base[i][4] > 20 * base[i][0] for i in after)
            plain = {i for i, m in base.items() if m[0] >= 10 and not m[4] and not m[2] and not m[3]}
            assert plain <= set(after)
        elif name == "near_copies":
            assert set(after) == set(classes_of(before).values())
        elif name == "repeated_passages":
            assert set(after) == {i for i, _ in before}
            cut = {}
            for i, _, _, n in spans_of(before):
                cut[i] = cut.get(i, 0) + n
            for i, t in before:
                assert len(words_of(after[i])) == len(words_of(t)) - cut.get(i, 0)
            # Cutting can bring words together, but what it cut is gone.
            assert not [s for s in spans_of(list(after.items())) if s[3] and cut.get(s[0], 0) == 0]
        else:
            leaks = {i for i, t in before if any(squeezed(x) in squeezed(t) for _, x in bench)}
            assert leaks and set(after) == {i for i, _ in before} - leaks
    assert cover([]) == []


def test_run_gives_what_the_stages_give(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in P.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(docs.select(columns).collect()) == sorted(P.run(spark, SF_DIR).select(columns).collect())


def test_hard_rows_go_through(spark, tmp_path):
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, extra STRING"
    good, other = prose(80, 1), prose(80, 2)
    rows = [
        (1, good, None, None, None, "x"),
        (1, good, "en", "s", 5, None),
        (2, None, None, None, None, None),
        (3, "", "en", "s", 0, "y"),
        (None, other, None, None, None, None),
        (4, prose(40_000, 3), "en", "s", 0, None),
    ]
    for n, data in enumerate((rows, [])):
        docs = spark.createDataFrame(data, schema)
        for name, stage in P.STAGES:
            stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / f"{name}{n}"))
            docs = spark.read.parquet(str(tmp_path / f"{name}{n}"))
        assert {r.doc_id for r in docs.collect()} == ({1, None, 4} if data else set())
