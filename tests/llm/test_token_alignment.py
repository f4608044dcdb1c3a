import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from rollcall.llm import token_alignment as ta
from rollcall.llm.catalogue import QUERIES

SF_DIR = "/root/testdata/sf0.001"
ODD = [
    None,
    "",
    " ",
    "a",
    " a  b   c ",
    "trailing \n \t",
    "x \n y\n\n  z",
    "it's we'll <|endoftext|> <s> <0x41> </s>",
    "naïve ÄÖÜß straße à la İstanbul ﬁ ½ 中文 العربية 🙂‍🙂 é",
    "wide　space and      hard  spaces \x85 \x1c \x00",
    "under ▁ bar",
    "▁",
    "same words same words same words",
    "same words same words same words",
    "Donaudampfschifffahrtsgesellschaft " * 30,
    "x" * 5000,
    "é" * 3000 + " ü",
    "0123456789 " * 200 + "\r\n",
]


@pytest.fixture(scope="module")
def libraries():
    path_a, path_b = ta.default_paths()
    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=path_b)


def byte_values():
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


def spans(tokens):
    out, at = [], 0
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def align(libraries, text):
    """Ids, groups and links of a whole text, straight from the contract."""
    a, b = libraries
    if not text:
        return None
    raw = " " + text
    ids_a, ids_b = a.encode(raw, add_special_tokens=False).ids, b.encode(text)
    values = byte_values()
    tokens_a = [bytes(values[c] for c in a.id_to_token(i)) for i in ids_a]
    tokens_b = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in ids_b
    ]
    if b"".join(tokens_a) != raw.encode() or b"".join(tokens_b) != raw.encode():
        return None
    spans_a, spans_b = spans(tokens_a), spans(tokens_b)
    groups, i, j = [], 0, 0
    for end in sorted({e for _, e in spans_a} & {e for _, e in spans_b}):
        k = next(x for x in range(i, len(spans_a)) if spans_a[x][1] == end) + 1
        m = next(x for x in range(j, len(spans_b)) if spans_b[x][1] == end) + 1
        groups.append((ids_a[i:k], ids_b[j:m]))
        i, j = k, m
    links, j = [], 0
    for x, (s, e) in zip(ids_a, spans_a):
        while spans_b[j][1] <= s:
            j += 1
        k = j
        while k < len(spans_b) and spans_b[k][0] < e:
            links.append((x, ids_b[k]))
            k += 1
    return ids_a, ids_b, groups, links


def expected(libraries, docs):
    found = [(i, align(libraries, t)) for i, t in docs]
    total = Counter(link for _, x in found if x for link in x[3])
    highest = {}
    for (_, b), n in total.items():
        highest[b] = max(highest.get(b, 0), n)
    out = []
    for i, x in found:
        if x is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        ids_a, ids_b, groups, links = x
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        best = sum(total[link] == highest[link[1]] for link in links)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out.append((i, len(ids_a), len(ids_b), len(groups), len(links), best, sum(total[x] for x in links), digest))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_odd_texts(make_docs, libraries):
    docs = list(enumerate(ODD))
    assert got(ta.align_and_score(make_docs(ODD))) == expected(libraries, docs)


def test_query_matches_whole_texts_aligned_one_by_one(spark, con, libraries):
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    assert got(QUERIES["op13_token_alignment"](spark, SF_DIR)) == expected(libraries, docs)


def test_chunks_and_whole_texts_agree(spark, make_docs, libraries, monkeypatch):
    texts = [t for t in ODD if t]
    pair = ta.vocabularies(*ta.default_paths())
    assert pair.apart
    for text in texts:
        found, plain = ta.Alignment(pair, " " + text), align(libraries, text)
        if plain is None:
            assert not found.whole
            continue
        assert found.ids_a.tolist() == plain[0] and found.ids_b.tolist() == plain[1]
        links = zip(found.ids_a[found.link_a].tolist(), found.ids_b[found.link_b].tolist())
        assert sorted(links) == sorted(plain[3])


def test_counts_in_several_blocks(make_docs):
    texts = ["some words of a text", "more words", "words", None, "some other text"]
    aligned = ta.align_documents(make_docs(texts))
    counts = ta.pair_counts(aligned)
    whole = ta.score_links(aligned, counts)
    columns = ["doc_id", "n_best", "count_sum"]
    assert got(ta.score_links(aligned, counts, block=3).select(columns)) == got(whole.select(columns))


def test_repeated_rows_null_ids_and_clashing_columns(make_docs, libraries):
    docs = [(None, "some words"), (1, "some words"), (1, "some words"), (1, "others"), (2, None)]
    rows = make_docs(docs).withColumnRenamed("source", "pairs").withColumnRenamed("lang", "n_best")
    assert got(ta.align_and_score(rows)) == expected(libraries, docs)
    assert ta.align_and_score(make_docs([])).collect() == []


def test_a_million_white_space_characters(make_docs, libraries):
    docs = [(1, "a" + " " * 1_200_000 + "b <|endoftext|>"), (2, "c")]
    rows = got(ta.align_and_score(make_docs(docs)))
    a, b = libraries
    assert [r[1] for r in rows] == [len(a.encode(" " + t, add_special_tokens=False).ids) for _, t in docs]
    assert [r[2] for r in rows] == [len(b.encode(t)) for _, t in docs]
