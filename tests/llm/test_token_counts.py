import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rollcall.llm import token_counts
from rollcall.llm.catalogue import QUERIES
from rollcall.session import run_dir

SF_DIR = "/root/testdata/sf0.001"
ODD = [
    "",
    None,
    " ",
    "\n\n  \t x\n",
    "a  b   c \n",
    "it's we'll I'm 'd '",
    "x<|endoftext|>y <|endoftext|>",
    "naïve ÄÖÜß Ǆ İ ﬁ ½ ² 中文 العربية 🙂‍🙂 é",
    "  \x85\x1c\x00",
    "aaaaaaaaaaaaaaaaaaaaaaaa" * 400,
    "same text",
    "same text",
]


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.no_truncation()
    found.no_padding()
    return found


def count(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_counts_are_those_of_the_library(spark, make_docs, library):
    rows = token_counts.count_tokens(make_docs(ODD), run_dir(spark, "cache")).collect()
    assert {(r.doc_id, r.n_bytes, r.n_tokens) for r in rows} == {
        (i, len((t or "").encode()), count(library, t)) for i, t in enumerate(ODD)
    }
    assert all(r.over_limit == (r.n_tokens > 512) for r in rows)


def test_query_matches_the_library(spark, con, library):
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    rows = QUERIES["op3_token_counts"](spark, SF_DIR).collect()
    assert {(r.doc_id, r.n_tokens) for r in rows} == {(i, count(library, t)) for i, t in docs}


def test_only_distinct_misses_are_encoded(spark, make_docs):
    cache = run_dir(spark, "cache")
    token_counts.add_missing(make_docs(["a", "b", "b", None, ""]), cache)
    first = spark.read.parquet(cache).collect()
    assert len(first) == 3
    token_counts.add_missing(make_docs(["b", "c", "c"]), cache)
    assert spark.read.parquet(cache).count() == 4


def test_another_vocabulary_has_its_own_counts(spark, make_docs, tmp_path):
    path = tmp_path / "other.json"
    with open(token_counts.default_path(), encoding="utf-8") as file:
        path.write_text(file.read() + "\n")
    cache = run_dir(spark, "cache")
    token_counts.add_missing(make_docs(["a"]), cache)
    token_counts.add_missing(make_docs(["a"]), cache, str(path))
    assert spark.read.parquet(cache).select("tokenizer").distinct().count() == 2


def test_empty_table_and_null_or_repeated_ids(spark, make_docs):
    assert token_counts.count_tokens(make_docs([]), run_dir(spark, "cache")).collect() == []
    rows = make_docs([(None, "a"), (1, "a"), (1, "a")]).withColumnRenamed("source", "digest")
    assert token_counts.count_tokens(rows, run_dir(spark, "cache")).count() == 3


def test_very_long_runs_of_white_space(spark, make_docs, library):
    texts = [f"a{space * 1_200_000}b <|endoftext|>" for space in " \n"] + ["\u3000" * 1_000_000, "c"]
    rows = token_counts.count_tokens(make_docs(texts), run_dir(spark, "cache")).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: count(library, t) for i, t in enumerate(texts)}
