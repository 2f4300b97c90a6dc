"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad.  Its features are its own and those of the lines before and after;
a transition weight ties neighbouring labels.  Forward-backward gives each line's marginal
probability of being good, and a document's quality is their mean, weighted by line length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces

#: The labelled sample that the model is fitted on: documents, and bytes and lines of one.  Features
#: of all their lines, 32 doubles each, are 150 MB at most.
SAMPLE, SAMPLE_BYTES, SAMPLE_LINES = 4_000, 6_000, 150
#: Steps of Adam, its rate, and the weight of the Gaussian prior.
STEPS, RATE, PRIOR = 150, 0.08, 1e-3

#: Features of a line: ten of its own, as many of either neighbour, first, last.
WIDTH = 32

_SYMBOLS = b"#*$%&|<>"


def _class(letters: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(letters)] = True
    return out


_CLASSES = [_class(bytes(range(65, 91))), _class(bytes(range(97, 123)) + bytes(range(128, 256))),
            _class(bytes(range(48, 58))), _class(_SYMBOLS), _class(b"!?"), _class(b" \t\x0b\f\r"),
            _class(b".,;:")]


@dataclass
class Lines:
    """Lines with a word of some texts: features, length, and where each text's lines end."""

    features: np.ndarray
    length: np.ndarray
    ends: np.ndarray


def lines(texts: list[str]) -> Lines:
    rows: list[bytes] = []
    ends, distinct, again = [], [], []
    for text in texts:
        seen: set[bytes] = set()
        for line in text.encode().split(b"\n"):
            words = line.split()
            if words:
                rows.append(line)
                distinct.append(len(set(words)) / len(words))
                again.append(line in seen)
                seen.add(line)
        ends.append(len(rows))
    ends_, n = np.array(ends, dtype=np.int64), len(rows)
    if not n:
        return Lines(np.zeros((0, WIDTH)), np.zeros(0), ends_)
    length = np.array([len(r) for r in rows], dtype=np.float64)
    data = np.frombuffer(b"".join(rows), dtype=np.uint8)
    begin = np.concatenate([[0], np.cumsum(length)[:-1]]).astype(np.int64)
    upper, lower, digit, symbol, bang, space, point = (
        np.add.reduceat(c[data].astype(np.int32), begin).astype(np.float64) for c in _CLASSES)
    words = space + 1
    own = np.stack([
        upper / (upper + lower + 1), symbol / words, bang / words, space / length, digit / length,
        point / words, np.minimum((length - space) / words, 40) / 10, np.log1p(length) / 5,
        np.array(distinct), np.array(again, dtype=np.float64)], axis=1)
    first = np.zeros(n, dtype=bool)
    first[np.concatenate([[0], ends_[:-1]])[np.diff(ends_, prepend=0) > 0]] = True
    last = np.concatenate([first[1:], [True]])
    before = np.where(first[:, None], 0, np.roll(own, 1, axis=0))
    after = np.where(last[:, None], 0, np.roll(own, -1, axis=0))
    return Lines(np.concatenate([own, before, after, first[:, None], last[:, None]], axis=1),
                 length, ends_)


def _padded(ends: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the lines of ``docs``, one document a row, and where there is a line."""
    begin = np.concatenate([[0], ends[:-1]])[docs]
    count = ends[docs] - begin
    step = np.arange(count.max())
    real = step < count[:, None]
    return np.where(real, begin[:, None] + step, 0), real


def _chain(unary: np.ndarray, real: np.ndarray, step: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of good for padded documents, and the expected number of each transition.

    ``unary`` is the score of good over bad of each line, ``step`` the 2 x 2 transition scores.
    """
    docs, width = unary.shape
    node = np.stack([np.zeros_like(unary), unary], axis=2)
    forward, backward = np.zeros((width, docs, 2)), np.zeros((width, docs, 2))
    forward[0] = node[:, 0]
    for t in range(1, width):
        both = forward[t - 1][:, :, None] + step
        move = np.logaddexp(both[:, 0], both[:, 1]) + node[:, t]
        forward[t] = np.where(real[:, t, None], move, forward[t - 1])
    for t in range(width - 2, -1, -1):
        both = step + (node[:, t + 1] + backward[t + 1])[:, None, :]
        move = np.logaddexp(both[:, :, 0], both[:, :, 1])
        backward[t] = np.where(real[:, t + 1, None], move, 0)
    total = np.logaddexp(forward[-1][:, 0], forward[-1][:, 1])
    joint = forward + backward
    good = np.exp(joint[:, :, 1] - np.logaddexp(joint[:, :, 0], joint[:, :, 1])).T
    moves = np.zeros((2, 2))
    for t in range(1, width):
        on = real[:, t]
        pair = (forward[t - 1][on][:, :, None] + step
                + (node[on, t] + backward[t][on])[:, None, :] - total[on][:, None, None])
        moves += np.exp(pair).sum(axis=0)
    return good, moves


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    step: np.ndarray

    def marginals(self, found: Lines) -> np.ndarray:
        """Probability of good for each line; documents of like length side by side."""
        out = np.zeros(len(found.length))
        if not len(out):
            return out
        unary = ((found.features - self.mean) / self.scale) @ self.weight + self.bias
        count = np.diff(found.ends, prepend=0)
        order = np.argsort(count, kind="stable")
        order = order[count[order] > 0]
        at = 0
        while at < len(order):
            # as many documents as fill a table of bounded size, of at most twice the length
            limit = int(np.searchsorted(count[order], 2 * count[order[at]], side="right"))
            stop = min(limit, at + max(1, 200_000 // int(count[order[limit - 1]])))
            place, real = _padded(found.ends, order[at:stop])
            good, _ = _chain(unary[place], real, self.step)
            out[place[real]] = good[real]
            at = stop
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        """Quality of each text; one without words has none: 0."""
        found = lines(texts)
        good = self.marginals(found)
        sums = [np.concatenate([[0], np.cumsum(x)]) for x in (good * found.length, found.length)]
        begin = np.concatenate([[0], found.ends[:-1]])
        part, whole = (s[found.ends] - s[begin] for s in sums)
        return np.clip(np.where(whole > 0, part / np.maximum(whole, 1), 0.0), 0.0, 1.0)


def run_of(length: np.ndarray, code: int, limit: int = SAMPLE_BYTES) -> slice:
    """Lines in a row of at most ``limit`` bytes (at least one) around the place that ``code``
    chooses; all if they are no more."""
    end = np.cumsum(length)
    if not len(length) or end[-1] <= limit:
        return slice(0, len(length))
    begin = end - length
    first = int(np.searchsorted(begin, code % int(end[-1]), "right")) - 1
    stop = max(first + 1, int(np.searchsorted(end, begin[first] + limit, "right")))
    return slice(min(first, int(np.searchsorted(begin, end[stop - 1] - limit))), stop)


def fit(texts: list[str], labels: list[int]) -> Model:
    """Maximum a posteriori fit; every line of a labelled document carries its label."""
    return fit_lines(lines(texts), labels)


def fit_lines(found: Lines, labels: list[int]) -> Model:
    width = found.features.shape[1]
    if not len(found.length) or len(set(labels)) < 2:
        bias = 5.0 if labels and min(labels) == 1 else -5.0 if labels else 0.0
        return Model(np.zeros(width), np.ones(width), np.zeros(width), bias, np.zeros((2, 2)))
    mean, scale = found.features.mean(axis=0), found.features.std(axis=0) + 1e-6
    x = (found.features - mean) / scale
    count = np.diff(found.ends, prepend=0)
    y = np.repeat(np.array(labels, dtype=np.float64), count)
    usable = np.flatnonzero(count > 0)
    usable = usable[np.argsort(count[usable], kind="stable")]
    groups = [_padded(found.ends, part) for part in np.array_split(usable, 1 + len(usable) // 256)
              if len(part)]
    share = np.array([np.mean(y == 0), np.mean(y == 1)])
    weigh = 0.5 / np.maximum(share, 1e-6)       # both labels count alike
    truth = np.zeros((2, 2))
    per_doc = weigh[np.array(labels, dtype=int)]
    theta = np.zeros(width + 1 + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    n = float(len(y))
    for turn in range(1, STEPS + 1):
        weight, bias, step = theta[:width], theta[width], theta[width + 1:].reshape(2, 2)
        unary = x @ weight + bias
        slope, moves = np.zeros(len(y)), np.zeros((2, 2))
        for k, (place, real) in enumerate(groups):
            for label in (0, 1):
                own = np.flatnonzero(y[place[:, 0]] == label)
                if len(own):
                    good, expected = _chain(unary[place[own]], real[own], step)
                    rows = place[own][real[own]]
                    slope[rows] = (label - good[real[own]]) * weigh[label]
                    truth[:] = 0
                    truth[label, label] = (real[own].sum(axis=1) - 1).sum()
                    moves += (truth - expected) * weigh[label]
        gradient = np.concatenate([x.T @ slope, [slope.sum()], moves.ravel()]) / n - PRIOR * theta
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta = theta + RATE * (first / (1 - 0.9**turn)) / (
            np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
    return Model(mean, scale, theta[:width], float(theta[width]), theta[width + 1:].reshape(2, 2))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features and lengths of the lines that each text is learned from."""
    for batch in pieces(batches, "text", 1 << 21):
        found = [lines([t]) for t in batch.column("text").to_pylist()]
        # a line counts as its share of the bytes at least, which bounds their number
        cuts = [run_of(np.maximum(x.length, SAMPLE_BYTES / SAMPLE_LINES), c) for x, c in zip(found, batch.column("code").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("code"), batch.column("quality"),
             pa.array([x.features[c].tobytes() for x, c in zip(found, cuts)], pa.binary()),
             pa.array([x.length[c].tobytes() for x, c in zip(found, cuts)], pa.binary())],
            names=["doc_id", "code", "quality", "features", "length"])


def learn(documents: DataFrame, labels: DataFrame) -> Model:
    """Fit on at most ``SAMPLE`` labelled documents, those with the smallest hash of their id.
    Of a document whose lines have more than ``SAMPLE_BYTES`` bytes, or are more than
    ``SAMPLE_LINES`` (short ones count as 40 bytes), a run of lines around a place chosen by hash
    is used, with the features that they have in the whole text.  Null ids,
    labels and texts are left out; of several labels of a document the smallest counts, of
    several texts that with the smallest hash."""
    marked = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
              .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    usable = documents.filter(F.col("text").isNotNull()).select("doc_id", "text")
    chosen = (usable.select("doc_id").join(marked, "doc_id").distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE))
    texts = usable.join(F.broadcast(chosen), "doc_id").groupBy(
        "doc_id", F.col("quality").cast("int").alias("quality")).agg(
        F.min(F.struct(F.xxhash64("doc_id", "text").alias("code"), "text")).alias("t")
        ).select("doc_id", "quality", "t.text", "t.code")
    rows = texts.mapInArrow(
        _runs, "doc_id long, code long, quality int, features binary, length binary"
        ).orderBy("doc_id", "code").collect()
    length = [np.frombuffer(r.length) for r in rows]
    found = Lines(np.frombuffer(b"".join(r.features for r in rows)).reshape(-1, WIDTH),
                  np.concatenate([np.zeros(0), *length]),
                  np.cumsum([len(x) for x in length], dtype=np.int64))
    return fit_lines(found, [r.quality for r in rows])


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score for every row of ``documents``; only doc_id and text are read.

    Score is between 0 and 1.  A text that is null or has no word scores 0.  A very long text is
    scored whole, its lines in one table.  Repeated rows come out as often as they come in.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 1 << 21):
            found = model.scores([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)],
                                             names=["doc_id", "score"])

    return documents.select("doc_id", "text").mapInArrow(work, "doc_id long, score double")
