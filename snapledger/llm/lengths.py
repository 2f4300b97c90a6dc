"""Token counts of whole texts by a tokenizer file, without keeping tokens.

Texts are encoded in batches of about the same number of bytes; only the lengths leave the
library.  A long text is cut where the tokenizer's own splitting always ends a piece, so that
its parts have together the tokens of the whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import pieces

#: Characters after which a text is cut, and bytes of a batch, about.
PART, BATCH = 1 << 14, 1 << 18

#: Places where a byte-level splitter always ends a piece: before white space after something
#: else, after a letter before an ASCII character that is none, after a digit likewise.
_ENDS = re.compile(r"(?<=\S)(?=[ \t\n\r\x0b\x0c])|(?<=[A-Za-z])(?=[!-@\[-`{-~])|(?<=[0-9])(?=[!-/:-~])")


class Counter:
    """The tokenizer of a file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        splitter, added = rules.get("pre_tokenizer") or {}, rules.get("added_tokens") or []
        #: Strings that are one token wherever they stand: no cut inside of them.
        self.special = [t["content"] for t in added]
        self.divisible = (
            not rules.get("normalizer") and splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
            and not any(t.get(k) for t in added for k in ("lstrip", "rstrip", "single_word")))

    def _inside(self, text: str, at: int) -> bool:
        return any(s in text[max(0, at - len(s) + 1):at + len(s) - 1] for s in self.special)

    def parts(self, text: str, size: int = PART) -> Iterator[str]:
        """``text`` in parts of about ``size`` characters, longer where there is no safe place."""
        begin = at = 0
        while self.divisible and len(text) - begin > size:
            found = _ENDS.search(text, max(begin + size, at))
            if not found:
                break
            if self._inside(text, found.start()):
                at = found.start() + 1
                continue
            yield text[begin:found.start()]
            begin = at = found.start()
        yield text[begin:]

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        parts, owner = [], []
        for k, text in enumerate(texts):
            for part in self.parts(text):
                parts.append(part)
                owner.append(k)
        done = np.cumsum([len(p.encode()) for p in parts], dtype=np.int64)
        lengths = np.zeros(len(parts), dtype=np.int64)
        shares = max(1, -(-int(done[-1]) // BATCH)) if parts else 0
        # each batch ends at the part that fills its even share of all bytes
        ends = np.searchsorted(done, np.arange(1, shares + 1) * int(done[-1]) / shares) + 1 if parts else []
        begin = 0
        for end in np.minimum(ends, len(parts)):
            coded = self.tokenizer.encode_batch_fast(parts[begin:end], add_special_tokens=False)
            lengths[begin:end] = [len(c) for c in coded]
            begin = max(begin, end)
        return np.bincount(owner, lengths, len(texts)).astype(np.int64)


_loaded: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The file, read once in a worker."""
    if path not in _loaded:
        _loaded[path] = Counter(path)
    return _loaded[path]


def count_tokens(documents: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit``) of every row of
    ``documents``; only ``doc_id`` and ``text`` are read.

    ``path`` is a tokenizer file that every executor has.  Nothing is added, cut or padded;
    special strings inside a text are the tokens that the file makes of them.  Null and empty
    texts have no tokens.  A very long text is encoded in parts; one without a safe place (a
    single word, say) is encoded whole.  Repeated rows come out as often as they come in.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(path)
        for batch in pieces(batches, "text", 1 << 22):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(model.count(texts))], names=["doc_id", "n_bytes", "n_tokens"])

    counted = documents.select("doc_id", "text").mapInArrow(
        work, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
