"""Token counts against the library on whole texts."""

import json
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

from snapledger.llm import lengths

from .frames import awkward, documents, empty, sf

PATH = public_tokenizers.path("byte_bpe_50k.json")


def slow(rows, path=PATH):
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    out = Counter()
    for doc_id, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False))
        out[doc_id, len((text or "").encode()), n, n > 512] += 1
    return out


def counted(df, path=PATH):
    return Counter(map(tuple, lengths.count_tokens(df, path).collect()))


def test_tables(spark):
    for df in (sf(spark), awkward(spark)):
        assert counted(df) == slow([(r.doc_id, r.text) for r in df.collect()])
    assert not counted(empty(spark))


HARD = [
    "<|endoftext|>" * 3000, "ab<|endoftext|>'s don't we'll 12ab  \n\n x" * 900, "x" * 40_000,
    "a1B2-c_d'e" * 5000, " " * 40_000 + "a", "\n \t" * 9000 + "é", "日本語。" * 9000, "é " * 9000,
    "x 　y\x85z\xa0 \x1c w " * 3000, "it's'm'd've'llx're" * 3000, "🙂‍🙂 ok" * 4000,
    "<|endoftext|" * 3000, "end<|endoftext|> " * 2000 + "  <|endoftext|>\n"]


def test_long_texts_are_cut_where_no_token_is(spark):
    rows = list(enumerate(HARD))
    assert counted(documents(spark, rows)) == slow(rows)


def test_any_part_size():
    model = lengths.Counter(PATH)
    for text in HARD:
        text = text[:3000]
        whole = len(model.tokenizer.encode(text, add_special_tokens=False))
        for size in (1, 2, 5, 17, 300):
            parts = list(model.parts(text, size))
            assert "".join(parts) == text
            assert sum(len(model.tokenizer.encode(p, add_special_tokens=False)) for p in parts) == whole


def test_batches_are_even(monkeypatch):
    monkeypatch.setattr(lengths, "BATCH", 1 << 10)
    model = lengths.Counter(PATH)
    sizes, coder = [], model.tokenizer

    class Watched:
        def encode_batch_fast(self, texts, **rest):
            sizes.append(sum(map(len, texts)))
            return coder.encode_batch_fast(texts, **rest)

    model.tokenizer = Watched()
    texts = ["word " * (k % 40) for k in range(700)] + ["", "last"]
    want = [len(coder.encode(t, add_special_tokens=False)) for t in texts]
    assert model.count(texts).tolist() == want
    assert max(sizes) <= 2 * (1 << 10) and len(sizes) == -(-sum(map(len, texts)) // (1 << 10))
    assert model.count([]).tolist() == [] and model.count(["", ""]).tolist() == [0, 0]


def test_other_files_are_not_cut(tmp_path, spark):
    """A tokenizer that folds or prefixes texts has no places known to be safe."""
    path = public_tokenizers.path("word_bpe_49k.json")
    model = lengths.Counter(path)
    text = "Word " * 9000
    assert list(model.parts(text)) == [text]
    assert counted(documents(spark, [(1, text)]), path) == slow([(1, text)], path)
    with open(PATH, encoding="utf-8") as file:
        rules = json.load(file)
    rules["pre_tokenizer"]["add_prefix_space"] = True
    (changed := tmp_path / "prefixed.json").write_text(json.dumps(rules), encoding="utf-8")
    assert counted(documents(spark, [(1, text)]), str(changed)) == slow([(1, text)], str(changed))
