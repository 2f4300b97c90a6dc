import base64
import random
import re
import sys

import public_tokenizers
import pytest
import tiktoken

from snapledger.llm.bpe import Ranks, encode, plain_pattern

from .frames import awkward, empty, sf

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def model():
    return Ranks(PATH, PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def lists(model, texts):
    ids, ends = model.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]


def check(df, library):
    rows = df.select("doc_id", "text").collect()
    got = sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in
                  encode(df, PATH, PATTERN).collect()), key=str)
    want = sorted(((r.doc_id, library.encode_ordinary(r.text or ""), (r.text or "").encode())
                   for r in rows), key=str)
    assert got == want


def test_awkward_rows(spark, library):
    check(awkward(spark), library)


def test_empty_table(spark):
    assert encode(empty(spark), PATH, PATTERN).collect() == []


def test_whole_small_table(spark, library):
    check(sf(spark), library)


@pytest.mark.parametrize("alphabet", ["ab", "the ing\n", "aé日🙂  \x1c\x85", "0123 ,.'s'll"])
def test_random_texts(model, library, alphabet):
    rng = random.Random(alphabet)
    texts = ["".join(rng.choices(alphabet, k=rng.choice([0, 1, 2, 3, 9, 40, 200, 900])))
             for _ in range(120)]
    assert lists(model, texts) == [library.encode_ordinary(t) for t in texts]
    ids, ends = model.encode(texts)
    assert [model.decode(ids[a:b]).decode() for a, b in zip(ends, ends[1:])] == texts


@pytest.mark.parametrize("below", [128, 1 << 16, sys.maxunicode + 1])
def test_every_code_point_splits_alike(model, library, below):
    """Up to the end of ASCII, of the basic plane, and of all: each has its own splitter."""
    points = [chr(i) for i in range(below if below < 1 << 17 else 0x323B0) if not 0xD800 <= i < 0xE000]
    texts = ["".join(f"a{c}1{c} {c}{c}." for c in points[i:i + 4000])
             for i in range(0, len(points), 4000)]
    assert lists(model, texts) == [library.encode_ordinary(t) for t in texts]


def test_memory_is_bounded(model, monkeypatch):
    from snapledger.llm import bpe
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    rng = random.Random(1)
    for _ in range(20):
        model.encode([" ".join("".join(rng.choices("qxzjv", k=8)) for _ in range(30))])
        assert len(model.seen) < 50 + 100


def test_plain_pattern():
    plain = plain_pattern(r" ?\p{L}+|[^\s\p{L}\p{N}]+|\S", 128)
    assert re.findall(plain, "ab c1.") == ["ab", " c", "1", "."]
    assert plain_pattern(r"\p{Lu}+", 128) is None
    assert plain_pattern(r"\w+", 128) is None


def test_a_long_piece(model, library):
    text = "x" * 3000 + " " * 500 + "ab" * 700
    assert lists(model, [text]) == [library.encode_ordinary(text)]
