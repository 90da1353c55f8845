import re
from collections import Counter
from math import log

import pytest

from seriesforge.llm import ngram_lm


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def plain(texts, order):
    docs = [words(t) for t in texts]
    counts, own = Counter(), []
    for d in docs:
        own.append(Counter(tuple(d[i : i + n]) for n in range(1, order + 1) for i in range(len(d) - n + 1)))
        counts.update(own[-1])
    tokens, out = sum(map(len, docs)), []
    for d, mine in zip(docs, own):
        total = 0.0
        for i in range(len(d)):
            for n in range(min(order, i + 1), 0, -1):
                gram = tuple(d[i - n + 1 : i + 1])
                seen = counts[gram] - mine[gram]
                if n == 1:
                    total += (order - 1) * log(0.4) + log(max(seen, 0.5)) - log(max(tokens - len(d), 1))
                elif seen > 0:
                    total += (order - n) * log(0.4) + log(seen) - log(counts[gram[:-1]] - mine[gram[:-1]])
                    break
        out.append((len(d), total))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_plain_counts(spark, docs_of, awkward, prose, order):
    texts = [*awkward, *[" ".join(prose(i, 40).split()[: 10 + i] * 2) for i in range(20)], *["the of the of a"] * 3]
    scored = ngram_lm.score(docs_of(texts, extra=True), order=order, batch_text=2000, table_text=5000)
    rows = {r["doc_id"]: r for r in scored.collect()}
    assert len(rows) == len(texts)
    for i, (n, total) in enumerate(plain(texts, order)):
        assert rows[i]["n_tokens"] == n and rows[i]["log_score"] == pytest.approx(total, abs=1e-6)
        assert rows[i]["mean_log_score"] == (pytest.approx(total / n) if n else None)


def test_batches_and_tables_do_not_matter(spark, docs_of, prose):
    texts = [prose(i % 7, 30 + i) for i in range(30)]
    runs = [ngram_lm.score(docs_of(texts), batch_text=b, table_text=t).orderBy("doc_id").collect() for b, t in ((1, 100), (10**8, 10**8))]
    assert [(r["doc_id"], round(r["log_score"], 8)) for r in runs[0]] == [(r["doc_id"], round(r["log_score"], 8)) for r in runs[1]]


def test_one_document_and_empty_table(spark, docs_of):
    only = ngram_lm.score(docs_of(["a b"])).first()
    assert only["log_score"] == pytest.approx(2 * (log(0.4) + log(0.5)))
    assert ngram_lm.score(docs_of([])).count() == 0
