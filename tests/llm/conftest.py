import random

import pytest

SYLLABLES = "the er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()


@pytest.fixture(scope="session")
def prose():
    """Seeded invented prose: prose(seed, n_words)."""

    def make(seed, n):
        r = random.Random(seed)
        return " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from texts; doc_id is the place unless given."""

    def make(texts, ids=None, extra=False):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", "src", len(t) if t is not None else None) for i, t in zip(ids, texts)]
        df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
        if extra:  # names that operators use inside or return
            names = "fp component_id node label text_key spans items value score n_words ids blob wanted bucket part"
            df = df.selectExpr("*", *[f"'x' AS {n}" for n in names.split()])
        return df.repartition(3)

    return make


@pytest.fixture(scope="session")
def awkward(prose):
    """NULL, empty, blank, very long, repeated and non-ASCII texts."""
    long = prose(1, 30_000)
    return [None, "", " \t\n\x0b", "one", "two words", long, long, long + " end", "É ß   中文 🙂 \x00 nul", prose(2, 60), prose(2, 60), "'s don't  'll\r\n x"]
