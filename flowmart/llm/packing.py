"""Best-fit packing of token sequences, hierarchical by what is left over.

Every document becomes its token ids and an end id. Documents longer than a sequence are cut into pieces of full length
and a rest; no other document is cut. Pieces are packed best-fit, longest first, within partitions. Sequences that are
nearly full are done. The others are the items of the next round: FAN_IN partitions merge into one and pack again, a
sequence that is not full being an item as long as its contents. The tree ends in one partition, to which only underfull
sequences come; each partition passes on at most CARRY of them, the emptiest, and the fuller ones stay as they are (no
piece is lost by it).

Token ids never leave the task that made them: what is packed are rows of (doc_id, piece, start, length, crc32).

NULL texts count as empty and give one piece with the end id alone. Repeated rows are packed each. Places do not depend
on the order in which rows arrive. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmart.llm.common import stored
from flowmart.llm.tokens import WordTokenizer

SEQUENCE = 2048
END = 0
FAN_IN = 8
CARRY = 20_000
NEARLY_FULL = 16  # free tokens at most, in the first round; the last round emits everything
_ROWS_A_PARTITION = 50_000

_PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_ITEM = (
    "node bigint, size int, members array<struct<doc_id: bigint, piece: int, start: bigint, length: bigint, "
    "ids_crc32: bigint, offset: bigint>>, done boolean"
)
_MEMBERS = pa.list_(
    pa.struct(
        [("doc_id", pa.int64()), ("piece", pa.int32())]
        + [(name, pa.int64()) for name in ("start", "length", "ids_crc32", "offset")]
    )
)


def pieces(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece; `tokenizer` is the path of a tokenizer file, which every
    executor reads for itself."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokenizer.at(tokenizer)
        tail = np.uint32(end).tobytes()
        for batch in batches:
            ids, places, starts, lengths, sums = [], [], [], [], []
            doc_ids = batch.column("doc_id")
            for row, data in enumerate(words.encoded(batch.column("text"))):
                data += tail
                for k, at in enumerate(range(0, len(data), 4 * sequence)):
                    part = data[at : at + 4 * sequence]
                    ids.append(row)
                    places.append(k)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    doc_ids.take(pa.array(ids, pa.int64())),
                    pa.array(places, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, _PIECE)


def best_fit(sizes: list[int], room: int) -> list[list[int]]:
    """Bins of places into sizes, in the order given (longest first): each goes where it leaves least room. Bins with the
    same room are kept together by room, so a step costs the logarithm of the number of different rooms."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []
    for place, size in enumerate(sizes):
        at = bisect.bisect_left(rooms, size)
        if at < len(rooms):
            left = rooms[at]
            held = by_room[left]
            chosen = held.pop()
            if not held:
                del by_room[left]
                rooms.pop(at)
            bins[chosen].append(place)
        else:
            left, chosen = room, len(bins)
            bins.append([place])
        left -= size
        if left > 0:
            if left not in by_room:
                by_room[left] = []
                bisect.insort(rooms, left)
            by_room[left].append(chosen)
    return bins


def _packed(items: DataFrame, parts: int, sequence: int, spare: int, last: bool) -> DataFrame:
    """One round: items (node, size, members) are dealt to `parts` partitions by node and packed there."""

    def order(item: tuple[int, list[dict]]) -> tuple:
        size, members = item
        m = members[0]
        return (-size, m["doc_id"] is None, m["doc_id"] or 0, m["piece"], m["ids_crc32"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, list[dict]]] = []
        for batch in batches:
            held += zip(batch.column("size").to_pylist(), batch.column("members").to_pylist(), strict=True)
        held.sort(key=order)
        bins = best_fit([size for size, _ in held], sequence)
        totals = np.array([sum(held[k][0] for k in b) for b in bins], np.int64)
        done = np.full(len(bins), last)
        if not last:
            done = totals >= sequence - spare
            open_ = np.flatnonzero(~done)
            if len(open_) > CARRY:
                done[open_[np.argsort(-totals[open_], kind="stable")[:-CARRY]]] = True
        contents = []
        for b in bins:
            members, offset = [m for k in b for m in held[k][1]], 0
            for m in members:
                m["offset"], offset = offset, offset + m["length"]
            contents.append(members)
        for at in range(0, len(bins), 1000):
            cut = slice(at, at + 1000)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(totals[cut]), TaskContext.get().partitionId(), np.int64)),
                    pa.array(totals[cut].astype(np.int32)),
                    pa.array(contents[cut], _MEMBERS),
                    pa.array(done[cut]),
                ],
                names=["node", "size", "members", "done"],
            )

    return items.repartition(parts, F.col("node")).mapInArrow(pack, _ITEM)


def packed(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end: int = END) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = stored(pieces(docs, tokenizer, sequence, end), "pieces")
    parts = max(1, -(-cut.count() // _ROWS_A_PARTITION))
    member = F.struct("doc_id", "piece", "start", "length", "ids_crc32", F.lit(0).cast("bigint").alias("offset"))
    # Pieces of full length are sequences as they are.
    sequences = cut.where(F.col("length") == sequence).select(F.array(member).alias("members"))
    node = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts))
    items = cut.where(F.col("length") < sequence).select(
        node.alias("node"), F.col("length").cast("int").alias("size"), F.array(member).alias("members")
    )
    spare = NEARLY_FULL
    while True:
        last = parts == 1
        packed_ = stored(_packed(items, parts, sequence, spare, last), "round")
        sequences = sequences.unionByName(packed_.where("done").select("members"))
        if last:
            break
        parts, spare = -(-parts // FAN_IN), spare * 2
        items = packed_.where("NOT done").select(F.pmod("node", F.lit(parts)).alias("node"), "size", "members")
    numbered = sequences.select(F.monotonically_increasing_id().alias("sequence_id"), "members")
    each = stored(numbered, "sequences").select("sequence_id", F.explode("members").alias("m"))
    return each.select("m.doc_id", "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id", "m.offset")
