import pytest

from tickbars.llm import quality_rules as Q

SCHEMA = "doc_id long, text string, source string, kept string, n_words int"


def brute(text):
    import re

    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(ws[i:i + 5]) for i in range(len(ws) - 4)]
    cover = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover))


@pytest.mark.parametrize("text", [
    "", " \t\n", "a", "a b c d e", "a b c d e a b c d e", "x " * 50, "éà ü# <b>\nq\nq\n\n q\nq",
    "a b c d\x1ce f", "one two three four five six " * 3 + "| * &", "日本 語 " * 9])
def test_counts_match_brute_force(text):
    assert Q.text_counts(text.encode()) == brute(text)


def test_rows_nulls_and_clashing_columns(llm):
    good = " ".join(f"w{i}" for i in range(20))
    rows = [(1, good, "a", "x", 5), (1, good, "a", "y", 6), (2, None, "a", None, None), (None, good, None, None, None),
            (3, "", "b", None, None), (4, "r s t u v " * 6, "b", None, None)]
    docs = llm.createDataFrame(rows, SCHEMA)
    out = sorted((r.doc_id or 0, r.n_words, r.base_failed, r.kept) for r in Q.quality_rules(docs).collect())
    assert out == [(0, 20, False, True), (1, 20, False, True), (1, 20, False, True), (2, 0, True, False),
                   (3, 0, True, False), (4, 30, True, False)]
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.kept or "") for r in kept.collect()) == [(0, ""), (1, "x"), (1, "y")]


def test_bad_host_takes_its_documents(llm):
    good = " ".join(f"w{i}" for i in range(20))
    rows = [(i, good, f"host{i % 10}", "", 0) for i in range(200)]
    rows += [(1000 + i, "short", "spam", "", 0) for i in range(400)] + [(2000, good, "spam", "", 0)]
    out = Q.quality_rules(llm.createDataFrame(rows, SCHEMA)).filter("not base_failed and not kept").collect()
    assert [r.doc_id for r in out] == [2000]


def test_empty_table(llm):
    assert Q.quality_rules(llm.createDataFrame([], SCHEMA)).count() == 0
    assert Q.keep_good(llm.createDataFrame([], SCHEMA)).count() == 0
