from collections import defaultdict

from conftest_llm import prose, words_of

from rollcall.llm import suffix_dedup
from rollcall.llm.catalogue import QUERIES


def cover(starts):
    out = []
    for s in sorted(starts):
        if out and s <= out[-1][1]:
            out[-1][1] = s + 50
        else:
            out.append([s, s + 50])
    return out


def brute_force(docs):
    """(doc_id, start, words, words to cut) of every run of 50 words that occurs again."""
    places = defaultdict(list)
    for i, t in docs:
        words = words_of(t)
        for s in range(len(words) - 49):
            places[tuple(words[s : s + 50])].append((i, s))
    found, cuts = defaultdict(set), defaultdict(set)
    for own in places.values():
        if len(own) > 1:
            first = min(own)
            for i, s in own:
                found[i].add(s)
                if (i, s) != first:
                    cuts[i].add(s)
    out = set()
    for i in found:
        cut = {w for a, b in cover(cuts[i]) for w in range(a, b)}
        out |= {(i, a, b - a, len(cut & set(range(a, b)))) for a, b in cover(found[i])}
    return out


def spans(df):
    return {tuple(r) for r in df.collect()}


def test_query_matches_brute_force(spark, con):
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    assert spans(QUERIES["op10_suffix_array_dedup"](spark, "/root/testdata/sf0.001")) == brute_force(docs)


P50, P51, P49, P120 = prose(50, 1), prose(51, 2), prose(49, 3), prose(120, 4)


def test_passages_of_fifty_words_and_more(make_docs):
    texts = [f"{prose(30 + n, 10 + n)} {p} {prose(40, 60 + n)}" for n, p in enumerate([P50, P51, P49, P120] * 3)]
    texts += [P120, f"{P120}\n\n{P50}", prose(300, 99)]
    got = spans(suffix_dedup.repeated_spans(make_docs(texts)))
    assert got == brute_force(list(enumerate(texts)))
    assert {i for i, *_ in got} == {n for n in range(12) if n % 4 != 2} | {12, 13}


def test_repeats_within_a_text_and_periods(make_docs):
    texts = ["la " * 200, prose(30, 5) + " " + (prose(33, 6) + " ") * 6, f"{P51} {P51}", None, "", "x"]
    assert spans(suffix_dedup.repeated_spans(make_docs(texts))) == brute_force(list(enumerate(texts)))


def test_one_copy_of_each_passage_stays(make_docs):
    texts = [f"{prose(20, 20 + n)}\n{P120}\n{prose(20, 40 + n)}" for n in range(30)] + [P50, "Clean  text\n", None]
    docs = make_docs(texts).withColumnRenamed("source", "cuts")
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs).collect()}
    assert len(got) == len(texts)
    assert got[0].text == texts[0]
    for n in range(1, 30):
        assert got[n].text == f"{prose(20, 20 + n)}\n{prose(20, 40 + n)}"
        assert got[n].n_chars == len(got[n].text)
    assert (got[30].text, got[31].text, got[32].text) == (P50, texts[31], None)
    assert brute_force([(i, r.text) for i, r in got.items()]) == set()
    assert suffix_dedup.remove_repeats(docs).columns == docs.columns


def test_case_and_white_space_do_not_matter(make_docs):
    texts = [P50, P50.upper().replace(" ", "\n")]
    assert spans(suffix_dedup.repeated_spans(make_docs(texts))) == {(0, 0, 50, 0), (1, 0, 50, 50)}


def test_null_and_repeated_ids(make_docs):
    rows = [(1, P51), (1, P51), (None, P50), (4, f"{P50} y")]
    got = sorted(spans(suffix_dedup.repeated_spans(make_docs(rows))), key=repr)
    assert got == sorted({(1, 0, 51, 0), (None, 0, 50, 0), (4, 0, 50, 50)}, key=repr)
    kept = sorted((r.text for r in suffix_dedup.remove_repeats(make_docs(rows)).collect()))
    assert kept == sorted([P51, P51, P50, "y"])


def test_empty_table_and_very_long_text(make_docs):
    assert spans(suffix_dedup.repeated_spans(make_docs([]))) == set()
    assert suffix_dedup.remove_repeats(make_docs([])).collect() == []
    long = prose(80_000, 8, 10**6)
    words = long.split()
    got = spans(suffix_dedup.repeated_spans(make_docs([long, " ".join(words[70_000:70_060])])))
    assert got == {(0, 70_000, 60, 0), (1, 0, 60, 60)}


def test_rows_without_id_or_of_one_id_are_documents_of_their_own(make_docs):
    lead, clean = prose(20, 21), prose(200, 22)
    rows = [
        (None, f"{prose(90, 23)} {P50} {P50} {prose(9, 24)}"),
        (None, clean),
        (None, "short"),
        (None, None),
        (None, f"{lead} {P120}"),
        (None, f"{prose(20, 25)} {P120}"),  # the same passage at the same start
        (None, P51),
        (None, P51),  # equal rows too
        (7, f"{prose(150, 26)} {P49} {P50}"),
        (7, prose(30, 27)),
        (7, f"{prose(60, 28)} {prose(60, 29)} {prose(60, 29)}"),
        (7, prose(240, 30)),
    ]
    # Every row with an id of its own, in place of the null and the repeated ones.
    wanted = brute_force(list(enumerate(t for _, t in rows)))
    got = suffix_dedup.repeated_spans(make_docs(rows)).collect()
    assert sorted(tuple(r)[1:3] for r in got) == sorted(w[1:3] for w in wanted)
    assert sum(r.n_cut for r in got) == sum(w[3] for w in wanted)
    kept = [r.text for r in suffix_dedup.remove_repeats(make_docs(rows)).collect()]
    assert len(kept) == len(rows) and brute_force(list(enumerate(kept))) == set()
    for text in (clean, "short", None, P51, rows[9][1], rows[11][1]):
        assert kept.count(text) == 1
    assert sum(P50 in (t or "") for t in kept) == sum(P120 in (t or "") for t in kept) == 1
    assert {lead, prose(20, 25)} & {(t or "").strip() for t in kept}
