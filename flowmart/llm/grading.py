"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text's features are hashed: its different words and a few marks of its form (length, symbols, capitals, variety). One
weight vector, shared by all grades, gives the text a place on a line; ordered thresholds cut the line into grades:
P(grade <= k) = 1 / (1 + exp(place - threshold k)). The expected grade and the tail probability P(grade >= top) follow.

Ratings combine the labels: quality (0, 1) and 1 - toxic (0, 1) add up to the grades 0, 1, 2. The model is fitted on a
bounded sample of labelled rows (`sample`, 20,000 rows, those with the least hash of their id); scoring covers all rows.

NULL texts count as empty and are scored by their form alone. Rows without any of the labels, or with a NULL id, are not
learned from. Of several ratings of an id the least counts. With less than two grades among the ratings every text gets
the mean rating and the tail probability of the ratings. Repeated rows are scored alike; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmart.llm.hashing import batches, hashed_words

SAMPLE = 20_000
BITS = 18
GRADES = 3
SELECT_FROM = 0.5
LEAST_DOCUMENTS = 5
STEPS = 150
PENALTY = 2e-5
_FORM = 64  # features of form, behind those of words
_SIZE = (1 << BITS) + _FORM

# Words are runs of letters and of bytes beyond ASCII.
_SEPARATORS = np.ones(256, bool)
_SEPARATORS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>@~^=+\\/{}[]")] = True


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(places of features, how many each text has); the features of a text are different and ascending."""
    words = hashed_words(texts, lower=True, separators=_SEPARATORS)
    hashed = (words.hashes >> np.uint64(64 - BITS)).astype(np.int64)
    pairs = np.unique(words.doc.astype(np.int64) * _SIZE + hashed)
    variety = np.bincount(pairs // _SIZE, minlength=len(texts)) / np.maximum(1, words.counts)
    form = []
    for k, text in enumerate(texts):
        data = np.frombuffer(text, np.uint8)
        symbols = _SYMBOLS[data].mean() if len(data) else 0.0
        capitals = ((data >= 65) & (data <= 90)).mean() if len(data) else 0.0
        marks = (
            min(15, int(np.log2(1 + words.counts[k]))),
            16 + min(15, int(symbols * 100)),
            32 + min(15, int(capitals * 30)),
            48 + min(15, int(variety[k] * 16)),
        )
        form += [k * _SIZE + (1 << BITS) + m for m in marks]
    both = np.sort(np.concatenate([pairs, np.array(form, np.int64)]))
    return both % _SIZE, np.bincount(both // _SIZE, minlength=len(texts))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    """weights by feature; thresholds, ascending, one fewer than grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, place: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 to the top grade, one column each."""
        return _sigmoid(place[:, None] - self.thresholds[None, :])


def fitted(places: np.ndarray, counts: np.ndarray, grades: np.ndarray) -> Model:
    """Maximum penalised likelihood by full-batch Adam steps. Features of fewer than LEAST_DOCUMENTS texts stay 0."""
    row = np.repeat(np.arange(len(counts)), counts)
    common = np.bincount(places, minlength=_SIZE) >= LEAST_DOCUMENTS
    used = common[places]
    column = np.cumsum(common)[places[used]] - 1
    row, n = row[used], int(common.sum())
    shares = np.array([(grades >= k).mean() for k in range(1, GRADES)]).clip(1e-4, 1 - 1e-4)
    first = np.log((1 - shares) / shares)
    # theta: weights, the first threshold, and the logarithms of the steps to the next ones.
    theta = np.concatenate([np.zeros(n), first[:1], np.log(np.maximum(0.05, np.diff(first)))])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    at = np.arange(len(grades))
    for step in range(1, STEPS + 1):
        place = np.bincount(row, theta[column], len(grades))
        gaps = np.exp(theta[n + 1 :])
        cuts = np.concatenate(([-np.inf], theta[n] + np.concatenate(([0.0], np.cumsum(gaps))), [np.inf]))
        below = _sigmoid(cuts[None, :] - place[:, None])
        slope = below * (1 - below)
        high, low = below[at, grades + 1], below[at, grades]
        chance = np.maximum(high - low, 1e-9)
        d_place = (slope[at, grades + 1] - slope[at, grades]) / chance  # of the negative log likelihood
        d_cuts = np.zeros(GRADES - 1)
        for k in range(1, GRADES):
            d_cuts[k - 1] = (slope[at, k] * ((grades == k) / chance - (grades == k - 1) / chance)).sum()
        tail = np.cumsum(d_cuts[::-1])[::-1]
        gradient = np.concatenate([np.bincount(column, d_place[row], n), tail[:1], tail[1:] * gaps]) / len(grades)
        gradient[:n] += PENALTY * theta[:n]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(_SIZE, np.float32)
    weights[common] = theta[:n]
    return Model(weights, theta[n] + np.concatenate(([0.0], np.cumsum(np.exp(theta[n + 1 :])))))


def ratings(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from quality and toxic."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    grade = F.when(F.col("quality") > 0, 1).otherwise(0) + F.when(F.col("toxic") > 0, 0).otherwise(1)
    return known.groupBy("doc_id").agg(F.min(grade).alias("grade"))


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def trained(docs: DataFrame, rated: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on at most `sample` rated documents. The sample is broadcast to find its texts, and its features (not its
    texts) come to the driver: both are bounded by `sample`."""

    def describe(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            texts = _texts(batch.column("text"))
            for a, b in batches(texts):
                places, counts = features(texts[a:b])
                offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(places.astype(np.int32)))
                ids = [batch.column(c).slice(a, b - a) for c in ("doc_id", "grade")]
                yield pa.RecordBatch.from_arrays([*ids, lists], names=["doc_id", "grade", "places"])

    chosen = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # Only these two columns, whatever others are called; of rows that share an id the same ones in every run.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    described = texts.select("doc_id", F.col("grade").cast("int"), "text").mapInArrow(
        describe, "doc_id bigint, grade int, places array<int>"
    )
    table = described.orderBy("doc_id", "places").limit(sample).toArrow()
    grades = table.column("grade").to_numpy().astype(np.int64)
    if len(set(grades.tolist())) < 2:
        share = [(grades >= k).mean() if len(grades) else 0.5 for k in range(1, GRADES)]
        share = np.clip(share, 1e-4, 1 - 1e-4)
        return Model(np.zeros(_SIZE, np.float32), np.log((1 - share) / share))
    lists = table.column("places").combine_chunks()
    counts = np.diff(lists.offsets.to_numpy())
    return fitted(lists.values.to_numpy()[lists.offsets[0].as_py() :], counts, grades)


def graded(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, expected_grade, top_probability, selected for every row. The model has a fixed size."""

    def score(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            texts = _texts(batch.column("text"))
            for a, b in batches(texts):
                places, counts = features(texts[a:b])
                row = np.repeat(np.arange(b - a), counts)
                above = model.above(np.bincount(row, model.weights[places], b - a))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(above.sum(axis=1)),
                        pa.array(above[:, -1]),
                        pa.array(above[:, -1] >= SELECT_FROM),
                    ],
                    names=["doc_id", "expected_grade", "top_probability", "selected"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id bigint, expected_grade double, top_probability double, selected boolean")
