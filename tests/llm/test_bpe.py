import base64

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.cases import edge_docs, edge_rows, no_docs

from sampleflow.llm.bpe import decode_ids, encode_texts, encoder

PATTERN = public_tokenizers.PATTERN
PATHS = [public_tokenizers.path(f"{x}.tiktoken") for x in ("byte_bpe_50k", "byte_bpe_multi_50k")]


def library(path):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module", params=PATHS)
def pair(request):
    return encoder(request.param, PATTERN), library(request.param)


def agree(pair, texts):
    own, other = pair
    ids, counts = own.encode_batch(texts)
    ends = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == [other.encode_ordinary(t) for t in texts]
    raw, cuts = own.decode_batch(ids.astype(np.int64), counts)
    assert raw.tobytes() == "".join(texts).encode() and cuts.tolist() == np.cumsum([len(t.encode()) for t in texts]).tolist()


def test_every_code_point(pair):
    agree(pair, [f"a{chr(c)}b {chr(c)}{chr(c)}" for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000])


def test_long_pieces(pair):
    agree(pair, ["", "a" * 5000, "ab" * 3000, " " * 1000 + "x", "\n" * 777, "日本" * 500, "=-" * 400, "x" * 256, "x" * 257, "\0" * 300])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(), max_size=8))
def test_any_text(texts):
    for path in PATHS:
        agree((encoder(path, PATTERN), library(path)), texts)


def test_table(spark):
    other = library(PATHS[1])
    got = decode_ids(encode_texts(edge_docs(spark), PATHS[1], PATTERN), PATHS[1], PATTERN).collect()
    have = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in got), key=repr)
    want = sorted(((d, other.encode_ordinary(t or ""), (t or "").encode()) for d, t, *_ in edge_rows()), key=repr)
    assert have == want
    assert encode_texts(no_docs(spark), PATHS[1], PATTERN).collect() == []


def test_ids_out_of_range():
    own = encoder(PATHS[0], PATTERN)
    with pytest.raises(ValueError):
        own.decode_batch(np.array([own.size]), np.array([1]))
