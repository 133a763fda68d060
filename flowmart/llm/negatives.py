"""Hard negatives by Four-Russians scoring: exact integer inner products by table look-ups instead of multiplications.

Vectors are quantised to whole numbers, floor(SCALE * x). For an anchor and a group of eight dimensions there is a table
of 256 sums, one for each subset of the eight values, built by doubling. A candidate is kept as bit planes: bit p of its
eight values in a group is one byte, which is the subset whose sum counts 2^p. So a score is, from the highest plane to
the lowest, twice what is there so far plus one table entry per group; the highest plane is the sign and is subtracted.
Tables of neighbouring anchors stand side by side, so that one byte fetches the sums of many anchors at once.

Anchors are a given set of rows and meet all rows, in blocks: rows and anchors are dealt by hash into blocks of about
ROWS and ANCHORS, every pair of blocks is one group of Spark's, and memory follows the size of blocks, not of the table.
First each pair of blocks yields the best rows of the anchor's label, whose merge gives the positives; then, with the
scores of the positives as bounds, the best rows of other labels within each band. No candidate is left out.

Rows with a NULL label or vector, or with a component that is NULL or not finite, take no part. Shorter vectors are
filled up with zeros. Rows that are equal in vec_id, label and quantised vector count once; a row is never its own
positive, nor is another row with its vec_id. Rows without vec_id are no anchors, come last among equal scores and are
reported with NULL. Quantised components beyond 2^24 are set to that bound, so that sums stay exact. Extra columns are not read;
empty tables, or no anchors, give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.llm.common import discarded, stored
from flowmart.workspace import written

SCALE = 256
ROWS = 1 << 13
ANCHORS = 1 << 13
_BOUND = 1 << 24
_SIDE = 128  # anchors whose tables stand side by side
_CHUNK = 1 << 11  # rows that are scored at once
_NONE = np.iinfo(np.int64).max  # stands for a missing vec_id, which comes last

_QUANTISED = "vec_id bigint, label bigint, anchor boolean, q binary"
_BLOCK = "n int, ids binary, labels binary, q binary"
_POSITIVE = "ablock int, place int, anchor_id bigint, positive_id bigint, positive_score bigint"
_NEGATIVE = (
    "ablock int, place int, nth int, anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, "
    "negative_score bigint"
)


def _quantised(rows: DataFrame) -> DataFrame:
    """The rows that take part: vec_id, label, anchor, and the whole numbers of the vector, 32 bits each."""

    def quantise(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            vectors = batch.column("vector")
            values = vectors.flatten()
            sizes = np.array([0 if x is None else x for x in vectors.value_lengths().to_pylist()], np.int64)
            x = values.fill_null(float("nan")).to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            odd = np.concatenate(([0], np.cumsum(~np.isfinite(x))))
            sound = vectors.is_valid().to_numpy(zero_copy_only=False) & (odd[ends[1:]] == odd[ends[:-1]])
            sound &= batch.column("label").is_valid().to_numpy(zero_copy_only=False)
            q = np.clip(np.floor(np.where(np.isfinite(x), x, 0) * SCALE), -_BOUND, _BOUND).astype("<i4")
            packed = [q[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            columns = [*(batch.column(name) for name in ("vec_id", "label", "anchor")), pa.array(packed, pa.binary())]
            names = ["vec_id", "label", "anchor", "q"]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(sound))

    return rows.mapInArrow(quantise, _QUANTISED)


def _blocks(rows: DataFrame, name: str, count: int) -> DataFrame:
    """One row per block: its different rows by vec_id, packed column by column."""

    def pack(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        ids = np.array([_NONE if x is None else x for x in group.column("vec_id").to_pylist()], np.int64)
        labels = group.column("label").to_numpy().astype(np.int64)
        vectors = group.column("q").to_pylist()
        places = {(i, y, v): k for k, (i, y, v) in enumerate(zip(ids.tolist(), labels.tolist(), vectors, strict=True))}
        order = [places[key] for key in sorted(places)]
        width = -(-max(map(len, vectors)) // 32) * 32  # whole groups of eight values
        packed = [
            [len(order)],
            [ids[order].tobytes()],
            [labels[order].tobytes()],
            [b"".join(vectors[k].ljust(width, b"\0") for k in order)],
        ]
        columns = [[key[0].as_py()], *packed]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        names = [name, "n", "ids", "labels", "q"]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})

    block = F.pmod(F.xxhash64("vec_id", "label", "q"), F.lit(count)).cast("int").alias(name)
    return rows.select(block, "vec_id", "label", "q").groupBy(name).applyInArrow(pack, f"{name} int, {_BLOCK}")


class _Block:
    """A block of rows: ids (_NONE for missing ones), labels, and the values, one row each."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.labels = np.frombuffer(row["labels"], np.int64)
        self.q = np.frombuffer(row["q"], "<i4").reshape(row["n"], -1)

    def widened(self, width: int) -> np.ndarray:
        return np.pad(self.q, ((0, 0), (0, width - self.q.shape[1])))


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of whole numbers, lowest first and the sign last: [plane, group of eight dimensions, row] -> byte."""
    low, high = int(values.min(initial=0)), int(values.max(initial=0))
    count = max(high.bit_length(), (-low - 1).bit_length() if low < 0 else 0) + 1
    one_plane = lambda p: np.packbits((values >> np.int32(p) & 1).astype(np.uint8), axis=1, bitorder="little").T
    return np.stack([one_plane(p) for p in range(count)])


def tables(anchors: np.ndarray, kind: type) -> np.ndarray:
    """Sums of every subset of eight values: [group, subset, anchor]."""
    groups = anchors.astype(kind).reshape(len(anchors), -1, 8).transpose(1, 2, 0)
    sums = np.zeros((len(groups), 256, len(anchors)), kind)
    for k in range(8):
        sums[:, 1 << k : 2 << k] = sums[:, : 1 << k] + groups[:, k, None]
    return sums


def scores(bits: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products [anchor, row] of anchors with rows that are given as bit planes."""
    most = int(np.abs(anchors.astype(np.int64)).sum(axis=1).max(initial=0)) << len(bits)
    kind = np.int32 if most < 1 << 31 else np.int64
    sums = tables(anchors, kind)
    out = np.empty((len(anchors), bits.shape[2]), kind)
    for a in range(0, bits.shape[2], _CHUNK):
        part = bits[:, :, a : a + _CHUNK].astype(np.intp)
        total = np.zeros((part.shape[2], len(anchors)), kind)
        fetched = np.empty_like(total)
        for p in range(len(part) - 1, -1, -1):
            total <<= 1
            for group, subset in zip(sums, part[p], strict=True):
                np.take(group, subset, axis=0, out=fetched, mode="clip")
                if p == len(part) - 1:
                    total -= fetched
                else:
                    total += fetched
        out[:, a : a + _CHUNK] = total.T
    return out


def best(values: np.ndarray, most: int) -> np.ndarray:
    """Places of the `most` greatest values, greatest first; of equal ones the first place."""
    at = np.arange(len(values))
    if len(values) > most:
        at = np.flatnonzero(values >= np.partition(values, len(values) - most)[len(values) - most])
    return at[np.argsort(-values[at].astype(np.int64), kind="stable")][:most]


def _each(rows: dict, anchors: dict) -> tuple[_Block, _Block, np.ndarray, np.ndarray]:
    """The two blocks with their values, filled up to the same width."""
    x, a = _Block(rows), _Block(anchors)
    width = max(x.q.shape[1], a.q.shape[1])
    return x, a, x.widened(width), a.widened(width)


def _table(schema: str, columns: list[list]) -> pa.Table:
    kinds = {"int": pa.int32(), "bigint": pa.int64()}
    fields = [field.split() for field in schema.split(", ")]
    flat = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
    arrays = {}
    for (name, kind), values in zip(fields, flat, strict=True):
        missing = values == _NONE if name.endswith("_id") else None
        arrays[name] = pa.array(values, kinds[kind], mask=missing)
    return pa.table(arrays)


def _block_pairs(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int):
    """Both tables of blocks dealt alike, every block of rows with every block of anchors. Spark shall not bring the
    small inputs of much work together in few tasks, so the number of partitions is given."""
    key = ["cblock", "ablock"]
    parts = min(2 * n_rows * n_anchors, 1 << 16)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("*", every(n_anchors).alias("ablock")).repartition(parts, *key)
    right = anchors.select("*", every(n_rows).alias("cblock")).repartition(parts, *key)
    return left.groupBy(*key).cogroup(right.groupBy(*key))


def _positives(pairs, most: int) -> DataFrame:
    """The best `most` rows of the anchor's label in each pair of blocks."""

    def find(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        columns: list[list] = [[] for _ in range(5)]
        if len(left) and len(right):
            x, a, xq, aq = _each(left.to_pylist()[0], right.to_pylist()[0])
            for label in np.unique(a.labels):
                rows, anchors = np.flatnonzero(x.labels == label), np.flatnonzero(a.labels == label)
                if not len(rows):
                    continue
                bits = planes(xq[rows])
                for s in range(0, len(anchors), _SIDE):
                    side = anchors[s : s + _SIDE]
                    for place, values in zip(side, scores(bits, aq[side]), strict=True):
                        other = np.flatnonzero(x.ids[rows] != a.ids[place])
                        top = other[best(values[other], most)]
                        sizes = np.full(len(top), 1)
                        found = (sizes * key[1].as_py(), sizes * place, sizes * a.ids[place], x.ids[rows][top], values[top])
                        for column, part in zip(columns, found, strict=True):
                            column.append(part.astype(np.int64))
        return _table(_POSITIVE, columns)

    return pairs.applyInArrow(find, _POSITIVE)


def _negatives(pairs, most: int, low: int, high: int) -> DataFrame:
    """The best `most` rows of other labels within the band of each positive, in each pair of blocks."""

    def find(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        columns: list[list] = [[] for _ in range(8)]
        if len(left) and len(right):
            given = right.to_pylist()[0]
            x, a, xq, aq = _each(left.to_pylist()[0], given)
            wanted: dict[int, list] = {}
            for p in given["positives"] or ():
                wanted.setdefault(p["place"], []).append(p)
            bits = planes(xq)
            places = np.array(sorted(wanted), np.int64)
            for s in range(0, len(places), _SIDE):
                side = places[s : s + _SIDE]
                for place, values in zip(side.tolist(), scores(bits, aq[side]), strict=True):
                    other = np.flatnonzero(x.labels != a.labels[place])
                    values = values[other]
                    for p in wanted[place]:
                        score = p["positive_score"]
                        # low * score <= 100 * negative <= high * score, in whole numbers
                        least, greatest = -(-low * score // 100), high * score // 100
                        inside = np.flatnonzero((values >= least) & (values <= greatest))
                        top = inside[best(values[inside], most)]
                        ones = np.ones(len(top), np.int64)
                        positive_id = _NONE if p["positive_id"] is None else p["positive_id"]
                        found = (
                            ones * key[1].as_py(), ones * place, ones * p["nth"], ones * a.ids[place], ones * positive_id,
                            x.ids[other][top], ones * score, values[top].astype(np.int64),
                        )
                        for column, part in zip(columns, found, strict=True):
                            column.append(part)
        return _table(_NEGATIVE, columns)

    return pairs.applyInArrow(find, _NEGATIVE)


def mined(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """Per anchor and positive the first hard negatives: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score. rows has vec_id, vector and label; low and high are percents of the positive's score."""
    given = rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.coalesce(is_anchor & F.col("vec_id").isNotNull(), F.lit(False)).alias("anchor"),
        F.col("vector").cast("array<double>").alias("vector"),
    )
    sound = stored(_quantised(given), "quantised")
    n, n_anchors = sound.agg(F.count("*"), F.count_if("anchor")).first()
    # One block of anchors exists always, so that an empty table takes the same way.
    n_rows, n_anchors = max(1, -(-n // ROWS)), max(1, -(-n_anchors // ANCHORS))
    blocks = stored(_blocks(sound, "cblock", n_rows), "rows")
    anchors = stored(_blocks(sound.where("anchor"), "ablock", n_anchors), "anchors")

    order = [F.desc("positive_score"), F.asc_nulls_last("positive_id")]
    nth = F.row_number().over(Window.partitionBy("ablock", "place").orderBy(*order)).alias("nth")
    found = _positives(_block_pairs(blocks, anchors, n_rows, n_anchors), positives).select("*", nth)
    found = found.where(F.col("nth") <= positives)
    bands = F.collect_list(F.struct("place", "nth", "positive_id", "positive_score")).alias("positives")
    bounded = stored(anchors.join(found.groupBy("ablock").agg(bands), "ablock"), "bands")

    order = [F.desc("negative_score"), F.asc_nulls_last("negative_id")]
    rank = F.row_number().over(Window.partitionBy("ablock", "place", "nth").orderBy(*order)).alias("rank")
    hard = _negatives(_block_pairs(blocks, bounded, n_rows, n_anchors), negatives, low, high).select("*", rank)
    out = hard.where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
    done = written(out, "negatives")
    discarded(sound, blocks, anchors, bounded)
    return done
