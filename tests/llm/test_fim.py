import re
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seriesforge.llm import fim

FEW = st.text(alphabet="aZ é<PSM>\n\x00🙂", max_size=60)


def by_reading(text, doc):
    """The contract, unit by unit."""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = sha256(f"1:{doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@given(FEW, st.integers(-5, 10**6))
@settings(max_examples=300, deadline=None)
def test_equals_reading(text, doc):
    assert fim.rearranged(text, str(doc), fim.Marks(), 10, 20) == by_reading(text, doc)


@given(FEW)
@settings(max_examples=100, deadline=None)
def test_pieces_do_not_show(text):
    whole = fim.unit_ends(text).tolist()
    size, fim.PIECE = fim.PIECE, 3
    try:
        assert fim.unit_ends(text).tolist() == whole
    finally:
        fim.PIECE = size


def test_rows_restore(spark, docs_of, awkward):
    seams = ["<", "<P", "P>", "<<P", "S><M", "a <P> b", "<S", ">", "<M<", "plain <S text>"] * 30
    texts = [*awkward, *seams]
    docs = docs_of(texts, extra=True).selectExpr("*", "1.5D AS form", "'x' AS output", "'x' AS restored")
    rows = fim.restore(fim.transform(docs)).collect()
    assert len(rows) == len(texts) and rows[0]["component_id"] == "x"
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == by_reading(text, r["doc_id"])
        assert r["restored"] == text
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}
    assert fim.transform(docs_of([])).count() == 0
    assert fim.digest(fim.transform(docs_of(["a b"], ids=[None]))).count() == 1


def test_rates_and_marks(spark, docs_of):
    docs = docs_of([f"some words number {i}" for i in range(200)])
    forms = {r["form"] for r in fim.transform(docs, plain_percent=0, spm_percent=100).collect()}
    assert forms == {"spm"}
    assert {r["form"] for r in fim.transform(docs, plain_percent=100).collect()} == {"plain"}
    marks = fim.Marks("<|pre|>", "<|suf|>", "<|mid|>")
    rows = fim.restore(fim.transform(docs, marks=marks), marks=marks).where("restored <> text").count()
    assert rows == 0
    for bad in (("aa", "ab", "ba"), ("<P>", "<P>", "<M>"), ("x<P>", "<P>", "<M>")):
        with pytest.raises(ValueError):
            fim.Marks(*bad)
