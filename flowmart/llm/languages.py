"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A run of three letters is bound into one vector: the first letter's
vector, permuted twice (rotated by two places), times the second's, permuted once, times the third's. The profile of a
text bundles, that is adds up, the vectors of all its runs; the prototype of a language bundles the profiles of its
texts, each scaled to its length so that long ones do not decide alone. A text gets the language whose prototype has the
greatest cosine with its profile; the score is that cosine, cut off at 0.

Letters are Unicode letters, lower case; what stands between them is one blank. The 26 letters of a-z have a vector each,
other letters share _OTHERS vectors by their code point. Runs of a text are counted first, so the work on vectors
depends on the number of different runs. Texts without a letter, and NULL texts, are `und` with score 0, as is every text
when nothing was learned. Ties go to the language that comes first by code point. Learning reads only text and
language; predicting reads only text. Repeated rows count as often as they occur. Empty tables give empty results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIMENSIONS = 1024
UNKNOWN = "und"
MOST_LANGUAGES = 1000  # the prototypes that a task holds: 4 MB at most
_HELD_LANGUAGES = 64  # whose sums a task holds, some 2 MB each
_OTHERS = 37
_SYMBOLS = 1 + 26 + _OTHERS
_CHUNK = 1 << 19  # characters that are looked at together


def _letter_table() -> np.ndarray:
    """Symbol of every code point: 0 for anything but a letter."""
    table = np.zeros(0x110000, np.int32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = ord(c.lower()[0])
            table[point] = low - 96 if 97 <= low <= 122 else 27 + zlib.crc32(str(low).encode()) % _OTHERS
    return table


class Runs:
    """Counts letter runs; made once for each worker process."""

    _made: Runs | None = None

    @classmethod
    def made(cls) -> Runs:
        if cls._made is None:
            cls._made = cls()
        return cls._made

    def __init__(self):
        self._letters = _letter_table()
        signs = np.random.default_rng(7).integers(0, 2, size=(_SYMBOLS, DIMENSIONS)).astype(np.int8) * 2 - 1
        self._turned = [np.roll(signs, k, axis=1) for k in (2, 1, 0)]

    def counted(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the text, code of the run, count) of all texts, ordered by text and code."""
        points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
        symbols = self._letters[np.minimum(points, 0x10FFFF)]
        doc = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
        # One blank between letters: a blank that follows a blank of the same text goes.
        kept = np.ones(len(symbols), bool)
        kept[1:] = (symbols[1:] > 0) | (symbols[:-1] > 0) | (doc[1:] != doc[:-1])
        symbols, doc = symbols[kept], doc[kept]
        # A blank in front of each text.
        heads = np.flatnonzero(np.diff(doc, prepend=-1))
        symbols, doc = np.insert(symbols, heads, 0), np.insert(doc, heads, doc[heads])
        codes = (symbols[:-2] * _SYMBOLS + symbols[1:-1]) * _SYMBOLS + symbols[2:]
        inside = (doc[:-2] == doc[2:]) & ((symbols[:-2] > 0) | (symbols[1:-1] > 0) | (symbols[2:] > 0))
        both, counts = np.unique(doc[:-2][inside] * _SYMBOLS**3 + codes[inside], return_counts=True)
        return both // _SYMBOLS**3, both % _SYMBOLS**3, counts

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        first, second, third = codes // _SYMBOLS**2, codes // _SYMBOLS % _SYMBOLS, codes % _SYMBOLS
        bound = self._turned[0][first] * self._turned[1][second]
        return (bound * self._turned[2][third]).astype(np.float32)

    def profiles(self, texts: list[str]) -> np.ndarray:
        """One row per text."""
        doc, codes, counts = self.counted(texts)
        out = np.zeros((len(texts), DIMENSIONS), np.float32)
        if len(codes):
            distinct, place = np.unique(codes, return_inverse=True)
            table = self.vectors(distinct)
            edges = np.searchsorted(doc, np.arange(len(texts) + 1))
            for k in range(len(texts)):
                own = slice(edges[k], edges[k + 1])
                out[k] = counts[own].astype(np.float32) @ table[place[own]]
        return out


def _chunks(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    start, held, size = 0, [], 0
    for k, text in enumerate(column):
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size > _CHUNK:
            yield start, held
            start, held, size = k + 1, [], 0
    if held:
        yield start, held


def prototypes(docs: DataFrame) -> list[tuple[str, np.ndarray]]:
    """(language, unit vector) for every language, by code point. docs: text, lang.

    Tasks send the sum of run frequencies of each of their languages, those of _HELD_LANGUAGES at a time, so that many
    labels take no more memory; sums are merged by (language, run), of which there are at most MOST_LANGUAGES * _SYMBOLS^3, whatever the size of the corpus. The driver gets one vector a language.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, sums = Runs.made(), {}

        def sent() -> Iterator[pa.RecordBatch]:
            for language, total in sums.items():
                codes = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(codes), pa.string()), pa.array(codes), pa.array(total[codes])],
                    names=["lang", "run", "share"],
                )
            sums.clear()

        for batch in batches:
            languages = batch.column("lang").to_pylist()
            for start, texts in _chunks(batch.column("text")):
                doc, codes, counts = runs.counted(texts)
                own = np.array(languages[start : start + len(texts)], object)
                totals = np.bincount(doc, counts, len(texts))
                share = counts / totals[doc] if len(doc) else counts
                for language in set(own.tolist()):
                    mine = own[doc] == language if len(doc) else np.zeros(0, bool)
                    sums.setdefault(language, np.zeros(_SYMBOLS**3))
                    sums[language] += np.bincount(codes[mine], share[mine], _SYMBOLS**3)
                    if len(sums) >= _HELD_LANGUAGES:
                        yield from sent()
        yield from sent()

    def bundle(key: tuple, group: pa.Table) -> pa.Table:
        codes, shares = group.column("run").to_numpy(), group.column("share").to_numpy()
        order = np.argsort(codes)
        vector = np.zeros(DIMENSIONS)
        for part in np.array_split(order, max(1, len(order) // 4096)):
            vector += shares[part] @ Runs.made().vectors(codes[part])
        return pa.table({"lang": [key[0].as_py()], "vector": pa.array([vector.tolist()], pa.list_(pa.float64()))})

    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    shares = labelled.mapInArrow(count, "lang string, run bigint, share double")
    merged = shares.groupBy("lang", "run").agg(F.round(F.sum("share"), 6).alias("share"))
    found = merged.groupBy("lang").applyInArrow(bundle, "lang string, vector array<double>").take(MOST_LANGUAGES + 1)
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    units = [(row["lang"], np.asarray(row["vector"])) for row in found]
    return [(name, v / np.linalg.norm(v)) for name, v in sorted(units, key=lambda u: u[0]) if np.linalg.norm(v) > 0]


def identified(docs: DataFrame, learned: list[tuple[str, np.ndarray]]) -> DataFrame:
    """All columns of docs but text in the struct _given, with lang_pred and score."""
    names = [name for name, _ in learned]
    matrix = np.array([vector for _, vector in learned], np.float32).reshape(len(names), DIMENSIONS)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs.made()
        for batch in batches:
            languages, scores = [], []
            for _, texts in _chunks(batch.column("text")):
                profiles = runs.profiles(texts)
                lengths = np.linalg.norm(profiles, axis=1)
                for k, length in enumerate(lengths):
                    if length == 0 or not names:
                        languages.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    cosines = matrix @ profiles[k] / length
                    best = int(np.argmax(cosines))
                    languages.append(names[best])
                    scores.append(float(min(1.0, max(0.0, cosines[best]))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_given"), pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                names=["_given", "lang_pred", "score"],
            )

    given = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("_given"), F.col("text"))
    kind = given.schema["_given"].dataType
    out = T.StructType(
        [
            T.StructField("_given", kind),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    return given.mapInArrow(predict, out)


def held_out(doc_id: Column) -> Column:
    """One of four parts by the checksum of the id, kept away from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_table(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score. Learns from the rows that are not held out."""
    learned = prototypes(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    rows = identified(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), learned)
    return rows.select("_given.doc_id", "_given.held_out", "lang_pred", "score")
