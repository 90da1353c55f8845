import random
import zlib

import pytest

from seriesforge.llm import toxicity as X

BAD = ["idiot", "worthless", "pathetic", "scumbag"]


@pytest.fixture(scope="module")
def case(prose):
    """Labelled documents; every fourth is toxic, and a third of those writes its words in disguise."""
    r = random.Random(3)
    disguise = {"idiot": "1d!0t", "worthless": "w0rthle55", "pathetic": "p a t h e t i c", "scumbag": "scuuuuumbag"}
    texts, labels = [], []
    for i in range(800):
        words = prose(i, r.randint(20, 120)).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(r.randint(2, 4)):
                bad = r.choice(BAD)
                words.insert(r.randrange(len(words)), disguise[bad] if i % 12 == 0 else bad)
        texts.append(" ".join(words))
        labels.append(int(toxic))
    return texts, labels


@pytest.fixture(scope="module")
def scored(spark, docs_of, case):
    texts, labels = case
    table = spark.createDataFrame([(i, 1, y) for i, y in enumerate(labels)] + [(5000, 1, 1), (None, 1, 1), (3, 1, None)], "doc_id bigint, quality int, toxic int")
    docs = docs_of(texts, extra=True)
    model = X.fit(docs, table)
    return model, table, docs


def test_held_out_accuracy(spark, case, scored):
    _, table, docs = scored
    rows = X.digest(docs, table).collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in range(800) if zlib.crc32(str(i).encode()) % 5 == 0}
    right = [r["predicted"] == case[1][r["doc_id"]] for r in held]
    assert sum(right) >= 0.97 * len(right)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_disguises_are_restored(scored):
    letters = scored[0].letters
    for chunk, word in (("1d!0t", "idiot"), ("w0rth1ess", "worthless"), ("p@thet1c", "pathetic"), ("iiiidiooooot", "idiot"), ("s.c.u.m.b.a.g", "scumbag"), ("$cumbag!!", "scumbag")):
        assert word in X.restored(chunk, letters), chunk
    assert X._spaced("you p a t h e t i c one") == ["pathetic"]
    assert X.restored("plain", letters) == ["plain"]


def test_viterbi_is_the_best_of_all_paths(scored):
    """Against every path of small lattices."""
    from itertools import product

    letters = scored[0].letters
    for chunk in ("1d10t", "5c|m", "aaab@", "l33t", "0"):
        best = None
        for path in product(*X.lattice(chunk)):
            word = "".join(p for p, _ in path)
            value = sum(c for _, c in path) + sum(letters.log_p(g[:2], g[2]) for g in X.trigrams_of(word))
            best = max(best, (value, word)) if best else (value, word)
        got = X.decode(chunk, letters)
        value = lambda w: max(sum(c for _, c in p) for p in product(*X.lattice(chunk)) if "".join(x for x, _ in p) == w) + sum(letters.log_p(g[:2], g[2]) for g in X.trigrams_of(w))
        assert value(got) == pytest.approx(best[0]), chunk


def test_awkward_texts_and_filter(spark, docs_of, awkward, scored):
    model = scored[0]
    docs = docs_of([*awkward, "you idiot pathetic worthless scumbag"], extra=True)
    rows = {r["doc_id"]: r["score"] for r in X.score(docs, model).collect()}
    assert rows[0] == rows[1] == rows[2] < 0.5 < rows[len(awkward)]
    kept = X.keep_clean(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(range(len(awkward)))


def test_without_labels(spark, docs_of, case):
    docs = docs_of(case[0][:20])
    schema = "doc_id bigint, quality int, toxic int"
    none = X.digest(docs, spark.createDataFrame([], schema)).collect()
    assert len(none) == 20 and all(r["predicted"] == 0 for r in none)
    clean = X.digest(docs, spark.createDataFrame([(i, 1, 0) for i in range(20)], schema)).collect()
    assert all(r["predicted"] == 0 for r in clean)
    few = X.digest(docs, spark.createDataFrame([(1, 1, 1), (2, 1, 0), (3, 1, 0)], schema)).collect()
    assert len(few) == 20
    assert X.digest(docs_of([]), spark.createDataFrame([(1, 1, 1)], schema)).count() == 0


def test_disguises_of_any_length(scored):
    """Long repeats, long edges, long glued chunks, long spaced runs, and chunks of signs or digits only."""
    letters = scored[0].letters
    assert "idiot" in X.restored("1d" + "i" * 70 + "0t", letters)
    assert "scumbag" in X.restored("$cumbag" + "!" * 40, letters)
    assert len(X.decode("w0rthle55" * 2000, letters)) == 18_000
    assert X._spaced(" ".join("pathetic" * 30)) == ["pathetic" * 30]
    signs = X.CharModel.of({g: 50 for g in X.trigrams_of("ass")})
    assert X.restored("@$$", signs) == ["ass"] and "ass" in X.restored("455", signs)
    assert "ass" in X.restored("(@$$)!", signs) and X.restored("---", signs) == []


def test_gaps_are_part_of_the_lattice(scored):
    """Leet and few distinct letters in spaced words; a run yields each of its words, not its beginning only."""
    letters = scored[0].letters
    assert "idiot" in X.spaced_words("well i d 1 0 t indeed", letters)
    assert "pathetic" in X.spaced_words("a p a t h e t i c", letters)
    assert {"idiot", "scumbag"} <= X.spaced_words("1 d i o t s c u m b a g", letters)
    assert {"idiot", "pathetic"} <= X.spaced_words("i d i o t   p a t h 3 t 1 c", letters)
    assert "scumbag" in X.spaced_words("s. c. u. m. b. a. g.", letters)
    assert X.spaced_words("one a b two", letters) == set()
    model = X.Model(X.CharModel.of({g: 50 for w in ("ass", "poop") for g in X.trigrams_of(w)}), {"ass$": 3.0, "poop$": 3.0}, [0.0] * 6)
    for text in ("you a s s", "p o o p here", "a 5 $ a $ s", "such a s s"):
        assert X._Scorer(model).evidence(text)[0] == 3.0, text


def test_all_labelled_rows_teach(spark, monkeypatch):
    """Counts and weights come from every labelled row outside the held-out fold, however many there are."""
    n = 26_000
    docs = spark.range(n).selectExpr("id AS doc_id", "IF(id % 4 = 0, 'you worthless thing', 'a friendly thing') AS text")
    labels = spark.range(n).selectExpr("id AS doc_id", "CAST(id % 4 = 0 AS int) AS toxic")
    counts, logistic, used = X._counts, X._logistic, []
    monkeypatch.setattr(X, "_counts", lambda rows: (used.append(rows.count()), counts(rows))[1])
    monkeypatch.setattr(X, "_logistic", lambda *a: (used.append(a[0].count() if hasattr(a[0], "count") else len(a[0])), logistic(*a))[1])
    model = X.fit(docs, labels)
    assert sum(used) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(n))
    assert "worthless$" in model.weights


def test_all_trigrams_and_features_are_learnt(spark, docs_of, prose):
    """More than 64 letters cubed, and more than 20,000 features."""
    r = random.Random(6)
    word = lambda low, high, n: "".join(chr(r.randint(low, high)) for _ in range(n))
    vile = " ".join(word(97, 122, 9) for _ in range(6000))
    signs = " ".join(word(0x4E00, 0x9FA5, 8) for _ in range(40_000))
    first = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 in (1, 2)]
    texts = [f"{vile if i % 2 else ''} {prose(i, 20)} {signs if i == first[0] else ''}" for i in range(100)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id bigint, toxic int")
    model = X.fit(docs_of(texts), labels)
    assert len(model.letters.counts) > 64**3 and len(model.weights) > 20_000
    assert {w + "$" for w in vile.split()} <= set(model.weights)


def test_only_words_that_may_count_are_examined(monkeypatch, prose, case, awkward, scored):
    """A chunk whose words begin like no feature is neither decoded nor looked up; evidence is that of every word."""
    model = scored[0]
    r = random.Random(8)
    signs = "".join(X.STANDS_FOR) + "___---...,,!?()<>\"' ²³ſßéЖ中a"
    noise = ["".join(r.choice(signs + "idotscumbagphetrwl") for _ in range(r.randint(1, 400))) for _ in range(300)]
    glued = [w[:k] + r.choice(signs) * r.randint(1, 4) + w[k:] for w in BAD for k in range(len(w) + 1) for _ in range(12)]

    def strongest(chunk):
        words = X.restored(chunk, model.letters)
        return max(((model.weights.get(f, 0.0), f) for w in words if len(w) >= 3 for f in X.features_of(w)), default=(0.0, ""))

    scorer = X._Scorer(model)
    for text in [*case[0][:60], *(t or "" for t in awkward[:5]), awkward[8], *noise, " ".join(glued), "a. " + "b" + "." * 300 + " c you"]:
        low = text.lower()
        chunks = {*low.split(), *X._spaced(low), *X.spaced_words(low, model.letters)}
        hits = sorted((h for h in map(strongest, chunks) if h[0] > 0), reverse=True)
        got = scorer.evidence(text)
        assert got[:2] == [h[0] for h in (*hits, (0.0, ""), (0.0, ""))[:2]] and (not hits or got[3] == sum(v for v, _ in hits) / X.log(2 + len(chunks)) ** 2), text
    calls = []
    for name in ("_best", "features_of"):
        monkeypatch.setattr(X, name, lambda *a, f=getattr(X, name): (calls.append(a), f(*a))[1])
    assert X._Scorer(model).evidence(" ".join(f"zyx{w} zy{w}! 20{i} q9{w}" for i, w in enumerate(prose(5, 500).split()))) == [0.0] * 5
    assert not calls
