"""Language identification by compression.

A language is a zstandard raw-content dictionary of sample texts.  A text belongs to the
language whose dictionary makes it smallest; when the runner-up is hardly larger, the text is
rejected.  Texts are compressed in lower case with one space for whatever is no letter, and in
blocks, so that the dictionary and not the text's own beginning decides about every part of it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces

#: The sample that a dictionary is made of: documents of a language, characters that are read of
#: each, bytes of the dictionary.
SAMPLE, SAMPLE_CHARS, DICTIONARY = 400, 2_000, 1 << 16
#: Slices of a language that its sample is chosen from.
SLICES = 64
#: Bytes that are compressed at once, and the level.
BLOCK, LEVEL = 4096, 5
#: Texts whose runner-up is less than this share larger are rejected.
MARGIN = 0.001
UNKNOWN = "und"
#: Small letters and all of UTF-8 beyond ASCII stay.
_LETTERS = bytes(b if b > 127 or 97 <= b <= 122 else 32 for b in range(256))


def normal(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(_LETTERS).split())


def dictionary(samples: list[tuple[bytes, int]], size: int = DICTIONARY) -> bytes:
    """Even shares of the texts, each from the place that its number chooses."""
    left, share = size, [0] * len(samples)
    order = sorted(range(len(samples)), key=lambda k: len(samples[k][0]))
    for at, k in enumerate(order):
        share[k] = min(len(samples[k][0]) + 1, left // (len(samples) - at))
        left -= share[k]
    out = []
    for (text, code), n in zip(samples, share):
        place = code % (len(text) - n + 2) if n else 0
        out.append((text[place:place + n - 1] + b" ")[:n])
    return b"".join(out)


def learn(labelled: DataFrame) -> dict[str, bytes]:
    """A dictionary for each language of ``labelled`` (doc_id, text, lang).

    At most ``SAMPLE`` documents of a language are used, those with the smallest hash of their
    id, and one text of each, that with the smallest hash; rows without text or lang are not.
    The bytes of the dictionary are shared out evenly
    among them, what short texts leave to the others, and a longer text gives a stretch at a
    place chosen by hash.  The sample is chosen by id and language alone, so texts are read for
    the chosen documents only.
    """
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()
                             & F.col("doc_id").isNotNull())
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    # Ranked in slices first: the task of a language gets SAMPLE * SLICES rows at most, however
    # many partitions its documents come from.
    sliced = Window.partitionBy("lang", "slice").orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    chosen = (usable.select("lang", "doc_id").distinct()
              .withColumn("slice", F.pmod(F.hash("doc_id"), F.lit(SLICES)))
              .withColumn("nth", F.row_number().over(sliced)).filter(F.col("nth") <= SAMPLE)
              .withColumn("nth", F.row_number().over(whole)).filter(F.col("nth") <= SAMPLE)
              .drop("slice"))
    start = F.pmod(F.xxhash64("lang", "doc_id"), F.greatest(
        F.length("text") - SAMPLE_CHARS + 1, F.lit(1))).cast("int") + 1
    rows = (usable.select("lang", "doc_id", F.col("text").substr(start, F.lit(SAMPLE_CHARS)).alias("t"))
            .join(F.broadcast(chosen), ["lang", "doc_id"]).groupBy("lang", "nth", "doc_id")
            .agg(F.min(F.struct(F.xxhash64("t"), "t")).alias("least"))
            .orderBy("lang", "nth").select("lang", "least.t", F.hash("doc_id").alias("code")).collect())
    samples: dict[str, list[tuple[bytes, int]]] = {}
    for row in rows:
        samples.setdefault(row.lang, []).append((normal(row.t), row.code))
    out = {lang: dictionary(found) for lang, found in samples.items()}
    return {lang: data for lang, data in out.items() if data.strip()}


class Compressors:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.languages = sorted(dictionaries)
        self.compress = []
        for lang in self.languages:
            content = zstandard.ZstdCompressionDict(
                dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.compress.append(zstandard.ZstdCompressor(
                dict_data=content, level=LEVEL, write_content_size=False).compress)

    def sizes(self, text: bytes) -> list[int]:
        blocks = [text[at:at + BLOCK] for at in range(0, len(text), BLOCK)]
        return [sum(map(len, map(compress, blocks))) for compress in self.compress]


def _classifier(dictionaries: dict[str, bytes], margin: float):
    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Compressors(dictionaries)
        for batch in pieces(batches, "text"):
            names, scores, rejected = [], [], []
            for text in batch.column("text").to_pylist():
                if not model.languages or not text or not any(map(str.isalpha, text)):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                sizes = np.array(model.sizes(normal(text)), dtype=float)
                best = int(np.argmin(sizes))
                second = np.delete(sizes, best).min() if len(sizes) > 1 else np.inf
                names.append(model.languages[best])
                scores.append(float(1 - sizes[best] / second))
                rejected.append(scores[-1] < margin)
            keep = [batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(rejected, pa.bool_())],
                names=[*batch.schema.names, "lang_pred", "score", "rejected"])

    return classify


def identify(documents: DataFrame, labelled: DataFrame, margin: float = MARGIN,
             carry: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """The columns ``carry`` (text among them), lang_pred, score, rejected for every row of
    ``documents``.

    ``score`` is the share by which the best dictionary beats the second; with one language
    learned it is 1.  Equal sizes go to the first language by name with score 0.  A text that
    is null or has no letter, or any text when nothing was learned, is ``und``, score 0,
    rejected.  A very long text is compressed whole, in blocks.  Only the columns ``carry`` of ``documents`` are read, and the prediction sees the text
    alone.  Repeated rows come out as often as they come in.
    """
    work = _classifier(learn(labelled), margin)
    rows = documents.select(*carry)
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("rejected", T.BooleanType())])
    return rows.mapInArrow(work, schema)
