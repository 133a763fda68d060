"""Substring dedup by relative Lempel-Ziv parsing: which words lie in a passage of `window` words that occurs elsewhere.

The corpus is its own reference. It is cut by content into blocks: neighbouring windows with the same anchor (the first
run of ANCHOR words with the least hash inside a window) form a block, so that equal passages are cut alike wherever they stand,
except at their ends. Each document is then a sequence of blocks, and is factored against the index of all blocks:

1. Index: every different block with its number of occurrences and the places of two of them, the reference.
2. Greedy step: from left to right, a block that the index holds elsewhere opens a factor, and the factor goes on as long as the next
   block is the one that follows in the reference. Any such factor is longer than `window` words.
3. Check at factor boundaries: a block that occurs once, but whose anchor occurs again, may hold the start or the end of
   a passage that the factors beside it miss. Its windows, and those of every different block with that anchor, are looked up
   one by one, and runs of windows that occur elsewhere are factors too, without a place in the reference.
4. Factors, all of at least `window` words, become duplicate spans; the words under a span are removed.

The result is exact up to collisions: a block is known by 128 bits (its anchor and its own hash), a window by 128. A window that occurs
twice has the same anchor both times, so both occurrences are in blocks that step 3 compares. Copies of a block count once in the index, however many there
are; hot blocks and anchors are summed before each shuffle and joined with the (unique) index side, which Spark can split.

NULL and empty texts have no words. Rows with equal doc_id and text are copies of one document: each repeats the other,
and both get a result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from flowmart.llm.common import released, row_key
from flowmart.llm.hashing import batches, hashed_words, mixed, running_least, windows
from flowmart.workspace import written

WINDOW = 35
ANCHOR = 8
_FACTOR = T.StructType([T.StructField(name, T.LongType()) for name in ("at", "length", "ref_doc_id", "ref_at")])
_CUT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
        T.StructField("factors", T.ArrayType(_FACTOR)),
    ]
)
_CUT_ARROW = to_arrow_type(_CUT)


def _blocks(hashes: np.ndarray, doc: np.ndarray, window: int, anchor: int):
    """Blocks of a batch: first word, number of windows, anchor, hash of the block's words."""
    whole = len(hashes) - window + 1
    if whole <= 0:
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    least, place = running_least(windows(hashes, anchor), window - anchor + 1)
    inside = np.flatnonzero(doc[:whole] == doc[window - 1 :])
    if not len(inside):
        return (inside, inside, np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    at = np.flatnonzero(np.diff(place[inside], prepend=-1))
    sizes = np.diff(np.append(at, len(inside)))
    # The hash of a block: its windows' hashes, weighted by their place, so it stands for the sequence.
    own = windows(hashes, window)[inside]
    order = (np.arange(len(inside)) - np.repeat(at, sizes)).astype(np.uint64)
    block = mixed(np.add.reduceat(mixed(own + order * np.uint64(0x9E3779B97F4A7C15)), at) + sizes.astype(np.uint64))
    return inside[at], sizes, least[inside[at]], block


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def blocks(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """One row per document: its blocks as arrays (first word, windows, anchor, block hash)."""

    def cut(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            texts = _texts(batch.column("text"))
            for a, b in batches(texts):
                w = hashed_words(texts[a:b])
                start, sizes, value, block = _blocks(w.hashes, w.doc, window, anchor)
                doc = w.doc[start] if len(start) else np.zeros(0, np.int64)
                offsets = pa.array(np.searchsorted(doc, np.arange(b - a + 1)), pa.int32())
                lists = [
                    pa.ListArray.from_arrays(offsets, pa.array(values))
                    for values in (
                        (start - w.first[doc] if len(doc) else start).astype(np.int32),
                        sizes.astype(np.int32),
                        value.view(np.int64),
                        block.view(np.int64),
                    )
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), batch.column("key").slice(a, b - a), *lists],
                    names=["doc_id", "key", "at", "size", "anchor", "block"],
                )

    lists = "at array<int>, size array<int>, anchor array<bigint>, block array<bigint>"
    return docs.mapInArrow(cut, f"doc_id bigint, key bigint, {lists}")


def _checked_windows(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(w1, w2, block, anchor, place, n) of every window of the wanted blocks, read from the text of one document each."""

    def look(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            texts = _texts(batch.column("text"))
            spans = batch.column("spans").to_pylist()
            for a, b in batches(texts):
                w = hashed_words(texts[a:b])
                first = w.first
                rows = [(s, first[k - a] + s["at"]) for k in range(a, b) for s in spans[k]]
                if not rows:
                    continue
                sizes = np.array([s["size"] for s, _ in rows])
                start = np.repeat(np.array([x for _, x in rows]), sizes)
                place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                at = start + place
                one, two = windows(w.hashes, window), windows(mixed(w.hashes + np.uint64(1)), window)
                column = lambda name: np.repeat(np.array([s[name] for s, _ in rows], np.int64), sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one[at].view(np.int64)),
                        pa.array(two[at].view(np.int64)),
                        pa.array(column("block")),
                        pa.array(column("anchor")),
                        pa.array(place.astype(np.int32)),
                        pa.array(column("n")),
                    ],
                    names=["w1", "w2", "block", "anchor", "place", "n"],
                )

    spans = wanted.groupBy("doc_id", "key").agg(F.collect_list(F.struct("at", "size", "block", "anchor", "n")).alias("spans"))
    same = docs["doc_id"].eqNullSafe(spans["doc_id"]) & (docs["key"] == spans["key"])
    rows = docs.join(spans, same).select(docs["text"], spans["spans"])
    # Copies of a row bring the same windows again: each block's windows count once.
    return rows.mapInArrow(look, "w1 bigint, w2 bigint, block bigint, anchor bigint, place int, n bigint").distinct()


def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, key, spans): for documents with repeated windows, blocks with their repeated windows. A span is
    (at, size, places, ref): places of the repeated windows of the block, or NULL for all; then ref is where the block stands
    elsewhere, (doc_id, key, at)."""
    spark = docs.sparkSession
    cut = written(blocks(docs, window, anchor), "blocks")
    each = F.inline(F.arrays_zip("at", "size", "anchor", "block"))
    repeated = written(
        cut.select(F.explode("anchor").alias("anchor")).groupBy("anchor").count().where("count > 1").select("anchor"),
        "anchors",
    )
    released(spark)
    found = written(cut.select("doc_id", "key", each).join(repeated, "anchor"), "found")
    released(spark)
    one = F.min(F.struct("doc_id", "key", "at", "size")).alias("one")
    other = F.max(F.struct("doc_id", "key", "at")).alias("other")
    index = written(found.groupBy("block", "anchor").agg(F.count("*").alias("n"), one, other), "index")
    # Anchors of which some block occurs once: only there can a passage start or end.
    open_anchors = index.groupBy("anchor").agg(F.min("n").alias("least")).where("least = 1").select("anchor")
    wanted = index.join(open_anchors, "anchor").select("one.*", "block", "anchor", "n")
    looked = written(_checked_windows(docs, wanted, window), "windows")
    released(spark)
    again = looked.groupBy("w1", "w2").agg(F.sum("n").alias("times")).where("times > 1").select("w1", "w2")
    block = ["block", "anchor"]
    partly = looked.join(again, ["w1", "w2"]).groupBy(*block).agg(F.array_sort(F.collect_set("place")).alias("places"))
    first = F.struct("one.doc_id", "one.key", "one.at").alias("first")
    hits = index.where("n > 1").select(*block, first, "other").unionByName(
        partly.join(index.where("n = 1").select(*block), block, "left_semi"), allowMissingColumns=True
    )
    itself = F.struct("doc_id", "key", "at").eqNullSafe(F.col("first"))
    ref = F.when(itself, F.col("other")).otherwise(F.col("first")).alias("ref")
    spans = found.join(hits, block).groupBy("doc_id", "key").agg(
        F.collect_list(F.struct("at", "size", "places", ref)).alias("spans")
    )
    return written(spans, "spans")


def _factors(spans: list[dict] | None, window: int) -> list[dict]:
    """The greedy parse: factors of a document against the reference, in order (factors may share words at their ends)."""
    factors: list[dict] = []
    whole = sorted((s for s in spans or () if s["places"] is None), key=lambda s: s["at"])
    source = None
    for span in whole:
        last, ref = factors[-1] if factors else None, span["ref"]
        here = (ref["doc_id"], ref["key"])
        step = span["at"] - last["at"] if last else 0
        if last and here == source and step == last["length"] - window + 1 and ref["at"] == last["ref_at"] + step:
            last["length"] += span["size"]
        else:
            factors.append({"at": span["at"], "length": span["size"] + window - 1, "ref_doc_id": ref["doc_id"], "ref_at": ref["at"]})
            source = here
    for span in spans or ():
        if span["places"] is not None:
            mask = np.zeros(span["size"] + window - 1, bool)
            for place in span["places"]:
                mask[place : place + window] = True
            for at, length in _runs(mask):
                factors.append({"at": span["at"] + at, "length": length, "ref_doc_id": None, "ref_at": None})
    return sorted(factors, key=lambda f: (f["at"], f["length"]))


def _mask(n: int, factors: list[dict]) -> np.ndarray:
    """True for the words under a factor."""
    edges = np.zeros(n + 1, np.int64)
    for factor in factors:
        edges[factor["at"]] += 1
        edges[factor["at"] + factor["length"]] -= 1
    return np.cumsum(edges[:-1]) > 0


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist(), strict=True))


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """_given, all other columns of docs as a struct; text, without the removed words (the kept ones joined by one space; as
    it was if none is removed); and a struct _cut with n_words, n_removed, kept_sha256 and factors (first word, length, and
    where the reference has the same words, if known)."""
    given = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        row_key(F.col("text")).alias("key"),
        F.col("text"),
        F.struct(*given).alias("_given"),
    )
    spans = repeated_spans(rows.select("doc_id", "key", "text"), window)

    def cut(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_:
            kept_texts, numbers = [], []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for whole, own in zip(texts, batch.column("spans"), strict=True):
                text = whole or b""
                words = text.split()
                factors = []
                kept = words
                if own.is_valid:
                    factors = _factors(own.as_py(), window)
                    mask = _mask(len(words), factors)
                    kept = [w for w, gone in zip(words, mask.tolist(), strict=True) if not gone]
                joined = b" ".join(kept)
                kept_texts.append(joined if len(kept) < len(words) else whole)
                numbers.append(
                    {
                        "n_words": len(words),
                        "n_removed": len(words) - len(kept),
                        "kept_sha256": hashlib.sha256(joined).hexdigest(),
                        "factors": factors,
                    }
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column("_given"), pa.array(kept_texts, pa.binary()).cast(pa.string()), pa.array(numbers, _CUT_ARROW)],
                names=["_given", "text", "_cut"],
            )

    same = rows["doc_id"].eqNullSafe(spans["doc_id"]) & (rows["key"] == spans["key"])
    joined = rows.join(spans, same, "left").select("_given", "text", "spans")
    out = T.StructType([joined.schema["_given"], T.StructField("text", T.StringType()), T.StructField("_cut", _CUT)])
    return joined.mapInArrow(cut, out)


def substring_table(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, factors."""
    return without_repeats(docs.select("doc_id", "text"), window).select("_given.doc_id", "_cut.*")


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with the repeated passages cut out of text, all columns in their old order. Texts without a repeated passage
    stay as they are, white space included."""
    cut = without_repeats(docs, window)
    return cut.select(*[F.col("text") if c == "text" else F.col(f"_given.`{c}`") for c in docs.columns])
