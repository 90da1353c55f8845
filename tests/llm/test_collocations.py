import re
from collections import Counter, defaultdict

import pytest

from seriesforge.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts_of(rows):
    """{lang: Counter of word tuples of one to three}, by reading."""
    out = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            for n in (1, 2, 3):
                out[lang or "und"].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return out


def phrases_of(rows, least, top):
    found = []
    for lang, f in counts_of(rows).items():
        total = sum(n for p, n in f.items() if len(p) == 1)
        often = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        kept = []
        for p, a in often.items():
            if any(len(q) > len(p) and 100 * m >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, m in often.items()):
                continue
            score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, l, r, total, -score))
    return sorted(found)


def mined(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(rows)], "doc_id bigint, text string, lang string")
    docs = docs.selectExpr("*", *[f"'x' AS {n}" for n in "phrase w1 n score rank bucket node".split()]).repartition(3)
    out = collocations.mine(docs, **options)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in out.collect())


@pytest.fixture(scope="module")
def rows(prose, awkward):
    chorus = "All happy families are alike and every one is alike; so it goes, so it goes on and on"
    short = [t if t is None else t[:1500] for t in awkward]
    texts = [chorus, chorus.upper(), "so it goes", prose(3, 200), prose(3, 200), prose(4, 900), *short]
    return [(t, g) for t in texts for g in ("en", "fr", None)] + [("the same word " + chr(65 + i % 26) * (i % 7 + 1), "en") for i in range(60)]


def test_equals_reading(spark, rows):
    """Nulls, empty, long and repeated texts; a pair with many followers; ties in score and count."""
    assert mined(spark, rows, least=2, top=300) == phrases_of(rows, 2, 300)


def test_blocks_and_buckets_do_not_show(spark, rows):
    """Texts cut into blocks of some words, edges spread over many buckets."""
    some = rows[:14] + rows[-60:]
    assert mined(spark, some, least=3, top=50, block_text=150, bucket_text=2000) == phrases_of(some, 3, 50)


def test_exact_beyond_64_bits(spark):
    frame = spark.createDataFrame([(2_000_000_011, 2_000_000_012, 2_000_000_012, 2_000_000_011, 2_000_000_013)], "a bigint, l bigint, r bigint, x bigint, y bigint")
    cut = frame.select(collocations._score("a", [("l", "r"), ("x", "y")]).alias("c")).first()["c"]
    a = 2_000_000_011
    want = min((10**6 * a * a // (l * r), k) for k, (l, r) in enumerate([(a + 1, a + 1), (a, a + 2)]))
    assert (cut["score"], cut["k"]) == want


def test_paths_hold_each_edge_once(spark, prose):
    """Sentences that share nothing become one path each; a shared middle splits them; long ones are cut into rows."""
    long = " ".join(f"w{i}" for i in range(2500))
    texts = ["a b c d e f"] * 3 + ["p b c d q"] * 2 + [long] * 2
    docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    graph = collocations.build(docs, least=2)
    paths = collocations.compact(graph).collect()
    by_words = {tuple(r["words"]): r["n"] for r in paths if r["words"][0][0] != "w"}
    # "b c" and "c d" are entered or left by two edges; "d e" is inner.
    assert by_words == {("a", "b", "c"): 3, ("p", "b", "c"): 2, ("b", "c", "d"): 5, ("c", "d", "e", "f"): 3, ("c", "d", "q"): 2}
    parts = sorted((r["part"], r["words"]) for r in paths if r["words"][0][0] == "w")
    assert [len(w) - 2 for _, w in parts] == [1000, 1000, 498] and all(r["n"] == 2 for r in paths if r["words"][0][0] == "w")
    joined = parts[0][1] + parts[1][1][2:] + parts[2][1][2:]
    assert " ".join(joined) == long
    triples = collocations._triples_of(collocations.compact(graph)).select("w1", "w2", "w3", "n").collect()
    assert sorted(map(tuple, triples)) == sorted((*t, n) for t, n in counts_of([(t, "en") for t in texts])["en"].items() if len(t) == 3 and n >= 2)


def test_empty(spark):
    assert mined(spark, []) == [] and mined(spark, [(None, "en"), (" . ", None)]) == []
