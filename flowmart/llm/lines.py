"""Line dedup by two Bloom filters: lines that several documents hold stay in the smallest doc_id only.

A line's key is the line without `[\\x20\\x09-\\x0D]` at both ends, A-Z lower-cased; keys of fewer than LEAST code points
are never dropped. What is compared are 128-bit BLAKE2 digests of keys. A line goes when its key is found in at least two
documents and its document is not the first (smallest doc_id) that holds it.

1. Gather: every task brings the digests of FLUSH lines together before it sends anything. Of a digest that several
   documents of the same flush hold, all but the smallest document are dropped at once, and only one entry is left. So a
   line that stands in every document is one entry per flush, whatever the number of documents.
2. Filters: the digests are split by their first bits into segments, as many as needed for about PER_SEGMENT entries
   each. Each segment has two Bloom filters of at least eight positions an entry, one for what was seen once and one for
   what was seen when the first already held it. Entries that are not in the second filter are in one document only: they
   end here, without a row of their own. Filters are as large as their segment, so none is too small for the input.
3. Confirmation: only suspected repeats become rows and are shuffled by their whole digest. There the first document is
   chosen, and suspicions of the filters that were wrong disappear. A digest has at most one row a flush.
4. The dropped digests of each document are joined to it, and its lines are cut.

Text is read twice and shuffled once, for step 4. NULL and empty texts are one empty line, which is too short to go. Rows
with equal doc_id are one document for the count of documents, and each loses what the id loses. Rows without doc_id are
documents of their own (copies of one text together one) and come after all others, in the order of a hash of their text.
Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from flowmart.llm.common import discarded, stored
from flowmart.workspace import written

LEAST = 10
FLUSH = 1 << 19
PER_SEGMENT = 1 << 20
_LEAST_BITS = 6
_WHITE = b" \t\n\x0b\x0c\r"
_DIGEST = 16
_GATHERED = (
    "n bigint, digests binary, ids binary, nameless binary, many binary, id bigint, nameless_key bigint, h1 bigint, h2 bigint"
)
_PACK = "segment bigint, digests binary, ids binary, nameless binary, many binary"
_PACKED = ["digests", "ids", "nameless", "many"]
_SUSPECT = "h1 bigint, h2 bigint, id bigint, nameless_key bigint, many boolean"
_CUT = T.StructType(
    [
        T.StructField("n_lines", T.LongType()),
        T.StructField("n_dropped", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
)


def _digest(line: bytes) -> bytes | None:
    """The digest of a line's key; None where the key is too short to count."""
    key = line.strip(_WHITE).lower()
    if len(key) < LEAST or (len(key) < 4 * LEAST and len(key.decode("utf-8", "replace")) < LEAST):
        return None
    return hashlib.blake2b(key, digest_size=_DIGEST).digest()


def _owners(docs: DataFrame) -> DataFrame:
    """docs with what tells documents apart: id, and nameless_key, which is 0 for documents that have an id."""
    nameless = F.when(F.col("doc_id").isNull(), F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseOR(F.lit(1)))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"),
        F.coalesce(nameless, F.lit(0)).alias("nameless_key"),
        *docs.columns,
    )


def _rows(schema: str, length: int, **columns) -> pa.RecordBatch:
    """A batch of `length` rows; columns that are not given are NULL."""
    arrays, names = [], []
    for field in schema.split(", "):
        name, kind = field.split()
        kind = {"bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[kind]
        value = columns.get(name)
        arrays.append(pa.nulls(length, kind) if value is None else pa.array(value, kind))
        names.append(name)
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _flushed(digests: bytes, ids: np.ndarray, nameless: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row with all different digests and their smallest documents, and a row for every line that is dropped for sure."""
    halves = np.frombuffer(digests, "<u8").reshape(-1, 2)
    order = np.lexsort((nameless, ids, nameless != 0, halves[:, 1], halves[:, 0]))
    halves, ids, nameless = halves[order], ids[order], nameless[order]
    new = np.ones(len(halves), bool)
    new[1:] = (halves[1:] != halves[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    own = np.cumsum(new) - 1
    other = (ids != ids[first][own]) | (nameless != nameless[first][own])
    many = np.zeros(len(first), bool)
    many[own[other]] = True
    if other.any():
        yield _rows(
            _GATHERED,
            int(other.sum()),
            id=ids[other],
            nameless_key=nameless[other],
            h1=halves[other, 0].view(np.int64),
            h2=halves[other, 1].view(np.int64),
        )
    packed = [halves[first].tobytes(), ids[first].tobytes(), nameless[first].tobytes(), many.tobytes()]
    yield _rows(_GATHERED, 1, n=[len(first)], **{name: [value] for name, value in zip(_PACKED, packed, strict=True)})


def _gathered(owned: DataFrame) -> DataFrame:
    """Rows of two kinds: with n the digests of a flush, without n a line that is dropped for sure."""

    def gather(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, counts, ids, nameless = [], [], [], []
        for batch in given:
            texts = batch.column("text").cast(pa.binary())
            owners = zip(batch.column("id").to_pylist(), batch.column("nameless_key").to_pylist(), strict=True)
            for text, (own, key) in zip(texts, owners, strict=True):
                lines = (text.as_py() or b"").split(b"\n")
                own_digests = {d for d in map(_digest, lines) if d is not None}
                digests.extend(own_digests)
                counts.append(len(own_digests))
                ids.append(own)
                nameless.append(key)
                if len(digests) >= FLUSH:
                    yield from _flushed(b"".join(digests), np.repeat(ids, counts), np.repeat(nameless, counts))
                    digests, counts, ids, nameless = [], [], [], []
        if digests:
            yield from _flushed(b"".join(digests), np.repeat(ids, counts), np.repeat(nameless, counts))

    return owned.select("id", "nameless_key", "text").mapInArrow(gather, _GATHERED)


def _unpacked(batch: pa.RecordBatch | pa.Table, k: int) -> tuple[np.ndarray, ...]:
    """Digests as two halves, ids, keys of nameless documents, and the marks, of the pack in row k."""
    kinds = ("<u8", np.int64, np.int64, bool)
    halves, *others = (np.frombuffer(batch.column(c)[k].as_py(), kind) for c, kind in zip(_PACKED, kinds, strict=True))
    return halves.reshape(-1, 2), *others


def _packs(flushes: DataFrame, bits: int) -> DataFrame:
    """Flushes cut into segments of digests with the same first bits."""

    def split(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            for k in range(len(batch)):
                entries = _unpacked(batch, k)
                segment = (entries[0][:, 0] >> np.uint64(64 - bits)).astype(np.int64)
                starts = np.flatnonzero(np.diff(segment, prepend=-1))
                ends = np.append(starts[1:], len(segment))
                parts = {
                    name: [part[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
                    for name, part in zip(_PACKED, entries, strict=True)
                }
                yield _rows(_PACK, len(starts), segment=segment[starts], **parts)

    return flushes.select(*_PACKED).mapInArrow(split, _PACK)


def _suspects(packs: DataFrame) -> DataFrame:
    """Entries that the second filter of their segment holds."""

    def filtered(group: pa.Table) -> pa.Table:
        entries = [_unpacked(group, k) for k in range(len(group))]
        size = 1 << max(6, (8 * sum(len(e[0]) for e in entries) - 1).bit_length())
        once, twice = np.zeros(size, bool), np.zeros(size, bool)
        last = np.uint64(size - 1)

        def places(halves: np.ndarray) -> np.ndarray:
            return np.stack([halves[:, 0] & last, halves[:, 1] & last, (halves[:, 1] >> np.uint64(32)) & last])

        for halves, _, _, many in entries:  # within a pack all digests differ
            at = places(halves)
            again = once[at].all(axis=0) | many
            twice[at[:, again]] = True
            once[at] = True
        held = []
        for halves, ids, nameless, many in entries:
            hit = twice[places(halves)].all(axis=0)
            held.append((halves[hit, 0].view(np.int64), halves[hit, 1].view(np.int64), ids[hit], nameless[hit], many[hit]))
        columns = [np.concatenate(parts) for parts in zip(*held, strict=True)]
        return pa.table(dict(zip(("h1", "h2", "id", "nameless_key", "many"), columns, strict=True)))

    return packs.groupBy("segment").applyInArrow(filtered, _SUSPECT)


def dropped_lines(owned: DataFrame) -> DataFrame:
    """(id, nameless_key, gone): the digests that each document loses; written."""
    gathered = stored(_gathered(owned), "lines")
    flushes = gathered.where("n IS NOT NULL")
    entries = flushes.agg(F.sum("n")).first()[0] or 0
    packs = _packs(flushes, max(_LEAST_BITS, (entries // PER_SEGMENT).bit_length()))
    owner = F.struct((F.col("nameless_key") != 0).alias("none"), "id", "nameless_key")
    same_line = Window.partitionBy("h1", "h2")
    confirmed = (
        _suspects(packs)
        .withColumn("owner", owner)
        .withColumn("first", F.min("owner").over(same_line))
        .where(F.col("owner") != F.col("first"))
    )
    lines = gathered.where("n IS NULL").select("id", "nameless_key", "h1", "h2")
    lines = lines.unionByName(confirmed.select("id", "nameless_key", "h1", "h2"))
    gone = written(
        lines.groupBy("id", "nameless_key").agg(F.collect_list(F.struct("h1", "h2")).alias("gone")), "dropped"
    )
    discarded(gathered)
    return gone


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """_given (all columns of docs as a struct), _text without the dropped lines, and the columns of _CUT."""
    whole = docs.select(F.struct("*").alias("_given"), F.col("doc_id"), F.col("text"))
    gone = dropped_lines(_owners(docs.select("doc_id", "text")))

    def cut(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            texts, numbers = [], []
            for text, lost in zip(batch.column("text").cast(pa.binary()), batch.column("gone"), strict=True):
                kept, n_lines, n_dropped = text.as_py() or b"", 1, 0
                n_lines += kept.count(b"\n")
                if lost.is_valid:
                    halves = np.array([(x["h1"], x["h2"]) for x in lost.as_py()], np.int64).tobytes()
                    digests = {halves[k : k + _DIGEST] for k in range(0, len(halves), _DIGEST)}
                    lines = [line for line in kept.split(b"\n") if _digest(line) not in digests]
                    n_dropped = n_lines - len(lines)
                    kept = b"\n".join(lines)
                texts.append(kept if text.is_valid else None)
                numbers.append((n_lines, n_dropped, hashlib.sha256(kept).hexdigest()))
            columns = zip(*numbers, strict=True) if numbers else ((), (), ())
            arrays = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, _CUT.fields, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_given"), pa.array(texts, pa.binary()).cast(pa.string()), *arrays],
                names=["_given", "_text", *_CUT.names],
            )

    rows = _owners(whole).join(gone, ["id", "nameless_key"], "left").select("_given", "text", "gone")
    out = T.StructType([rows.schema["_given"], T.StructField("_text", T.StringType()), *_CUT.fields])
    return rows.mapInArrow(cut, out)


def line_table(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_sha256."""
    return without_repeated_lines(docs.select("doc_id", "text")).select("_given.doc_id", *_CUT.names)


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs, all columns in their order, with the dropped lines cut out of text."""
    cut = without_repeated_lines(docs)
    return cut.select(*[F.col("_text").alias("text") if c == "text" else F.col(f"_given.`{c}`") for c in docs.columns])
