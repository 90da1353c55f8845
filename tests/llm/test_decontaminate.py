import random
import re

import pytest

from seriesforge.llm import decontaminate as D


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(text, items):
    """(n_words, n_hit, items) by comparing every window with every position."""
    own, hit, found = words(text), set(), set()
    for item, body in items:
        w = words(body)
        size = min(len(w), D.WINDOW)
        patterns = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if size else set()
        for i in range(len(own) - size + 1 if size else 0):
            if tuple(own[i : i + size]) in patterns:
                hit.update(range(i, i + size))
                found.add(str(item))
    return len(own), len(hit), sorted(found)


@pytest.fixture(scope="module")
def case(prose):
    r = random.Random(4)
    items = [(i, prose(100 + i, r.choice([1, 5, 13, 14, 40]))) for i in range(20)]
    items += [(20, items[3][1]), (20, items[4][1]), (21, None), (22, " .. "), (23, "the the the the")]
    texts = [None, "", "...", "the", "The the, THE the! the", prose(3, 3000) + " " + items[5][1]]
    for i, body in items[:20]:
        cut = body.split()[: r.randint(3, 40)]
        texts += [f"{prose(i, 50)}é-{body.upper()}.{prose(i, 9)}", " ".join(cut) + " " + prose(i, 20), body, body]
    return texts, items


@pytest.mark.parametrize("chars", [D.AUTOMATON_CHARS, 4000])
def test_against_brute_force(spark, docs_of, case, chars):
    texts, items = case
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = D.find_contamination(docs_of(texts, extra=True), bench, automaton_chars=chars).collect()
    assert len(found) == len(texts)
    for r in found:
        n, hit, names = plain(texts[r["doc_id"]], items)
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, hit, names)
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)
        covered = [w for s in r["spans"] for w in words(texts[r["doc_id"]][s["start"] : s["end"]])]
        assert len(covered) == hit


def test_repeated_ids_are_judged_by_their_text(spark, docs_of, case, prose):
    _, items = case
    docs = docs_of([items[0][1] + " " + items[1][1] + " " + prose(1, 3), prose(2, 40), prose(2, 40)], ids=[5, 5, None], extra=True)
    bench = spark.createDataFrame(items[:2], "item_id bigint, text string")
    for chars in (D.AUTOMATON_CHARS, 60):
        kept = D.keep_clean(docs, bench, automaton_chars=chars)
        assert kept.columns == docs.columns
        assert [r["text"] for r in kept.collect()] == [prose(2, 40)] * 2


def test_empty_tables(spark, docs_of, case):
    bench = spark.createDataFrame(case[1], "item_id bigint, text string")
    assert D.find_contamination(docs_of([]), bench).count() == 0
    rows = D.digest(D.find_contamination(docs_of(["a b", None]), bench.limit(0))).collect()
    assert all(r["n_hit"] == 0 and not r["contaminated"] for r in rows) and len(rows) == 2
