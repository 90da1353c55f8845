import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from seriesforge.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


PIECES = ["a", "st", "'s", "'re", "'ll", "'", "d", " ", "  ", "\n", "\t", "\r\n", "5", "٣", "é", "中", "🙂", "!", "　", " ", "<|endoftext|>", "E"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=1, max_size=6))
def test_same_ids_as_the_library(ranks, library, texts):
    got = list(bpe.encode_batch([t.encode() for t in texts], bpe._Pieces(ranks, 50)))
    assert got == [library.encode_ordinary(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_any_text(ranks, library, text):
    assert list(bpe.encode_batch([text.encode()], bpe._Pieces(ranks, 50))) == [library.encode_ordinary(text)]


def test_long_pieces_and_block_borders(ranks, library):
    r = random.Random(2)
    texts = ["a" * 5000, " " * 700, "'" * 300, "ab" * 400 + "'s", "x" * 255 + "'ll y", "x" * 256 + " y", "".join(r.choice("ab ") for _ in range(3000))]
    assert list(bpe.encode_batch([t.encode() for t in texts], bpe._Pieces(ranks, 50))) == [library.encode_ordinary(t) for t in texts]


def test_every_code_point_has_the_class_of_the_library(ranks, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][:: 7]
    texts = ["s" + chr(c) + "t1" + chr(c) + " " + chr(c) + "!" for c in points]
    got = list(bpe.encode_batch([t.encode() for t in texts], bpe._Pieces(ranks, 1000)))
    assert got == library.encode_ordinary_batch(texts)


def test_functions_compose_associatively():
    follow, begins, images, product, number = bpe._monoid()
    m = len(images)
    for a in range(m):
        for b in range(m):
            assert np.array_equal(images[product[a, b]], images[b][images[a]])
    assert len({tuple(i) for i in images}) == m


def test_texts_of_a_table(spark, docs_of, awkward, library, ranks):
    docs = docs_of(awkward, extra=True)
    encoded = bpe.encode(docs, PATH, cached=40)
    rows = {r["doc_id"]: r for r in encoded.collect()}
    assert set(encoded.columns) == {*docs.columns, "ids", "token_ends"}
    tokens = {i: t for t, i in ranks.items()}
    for i, text in enumerate(awkward):
        raw = (text or "").encode()
        assert rows[i]["ids"] == library.encode_ordinary(text or "")
        starts = [0, *rows[i]["token_ends"]]
        assert [raw[a:b] for a, b in zip(starts, starts[1:])] == [tokens[k] for k in rows[i]["ids"]]
    found = {r["doc_id"]: r for r in bpe.digest(docs, PATH).collect()}
    for i, text in enumerate(awkward):
        ids = library.encode_ordinary(text or "")
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_empty_table(spark, docs_of):
    assert bpe.digest(docs_of([]), PATH).count() == 0


def test_decoding_follows_the_offsets(spark, docs_of, awkward):
    encoded = bpe.encode(docs_of(awkward), PATH)
    want = {i: (t or "").encode() for i, t in enumerate(awkward)}
    for given, ends in ((encoded, "token_ends"), (encoded.drop("token_ends"), None)):
        found = bpe.decode(given, PATH, ends_col=ends)
        assert not {"ids", "token_ends"} & set(found.columns)
        assert {r["doc_id"]: bytes(r["decoded"]) for r in found.collect()} == want
    vocabulary, sizes = np.frombuffer(b"abcde", np.uint8), np.array([1, 2, 2])
    starts = np.array([0, 1, 3])
    put = lambda ids, ends: bpe._put_together(np.array(ids, int), np.array(ends, int), vocabulary, starts, sizes)
    assert put([1, 0, 2], [2, 3, 5]) == b"bcade" and put([], []) == b""
    for ids, ends in (([1, 0], [1, 3]), ([1], [2, 3]), ([3], [1]), ([-1], [2])):
        with pytest.raises(ValueError):
            put(ids, ends)
