"""Cross-tokenizer alignment: groups and links of two tokenizations, with corpus-wide counts by minimal perfect hashing.

Tokenizer A is a byte-level BPE file, B a SentencePiece model; both read a space and the text. Where a token of A and a token
of B end at the same byte a group ends; a token of A and one of B are linked where their bytes overlap. How often an
id pair is linked in the whole corpus is counted, and each document reports the counts of its own links.

1. First pass: texts fall apart at single spaces between other characters. Neither tokenizer has a token across such a
   space (A cuts there before merging, no piece of B has a space behind another character; both are checked on load), so a
   text is the row of its units. Tasks align every different unit of a flush once, all of them in one set of
   array operations, and send the different id pairs with their counts, by shards of B ids.
2. Minimal perfect hash: the different pairs of a shard get the numbers 0 to n - 1. A pair hashes to one of 2 n places; who
   is alone there is settled and the others go on to the next level. The number of a pair is the rank of its place among
   all settled ones. At a number stands the pair itself, so that a look-up can verify it.
3. Counts: every flush becomes a dense vector of counts, indexed by the hash; vectors are summed as a tree, first within
   slices of FAN flushes, then over slices. The greatest count of each B id is in its own shard, so it is marked there.
4. Second pass: documents are aligned again and look up their pairs. The hash of at most SLICE pairs (or one shard) is
   broadcast at a time, some 40 MB: a shard has at most 50,257 * 32 pairs by the size of the vocabularies. More pairs take
   more rounds over the documents, whose sums are added.

Texts that are NULL, empty, or that one tokenizer does not give back byte for byte, have no tokens: zeros and an empty
groups_sha256. Special-token strings are plain text. Rows with equal doc_id and text are counted each and get equal
results. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmart.llm.common import discarded, row_key, stored
from flowmart.llm.hashing import mixed
from flowmart.llm.tokens import _byte_letters

SHARDS = 1024
SLICE = 1 << 21
FAN = 64
_HELD = 1 << 20  # units of a flush
_DOCUMENTS = 256  # documents that are split together
_TOGETHER = 256  # units that are encoded as one text
# White space of any kind at an end of a text or beside a blank, where a cut would have to look further.
_SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
_SPACED = f"{_SPACE} | {_SPACE}|^{_SPACE}|{_SPACE}$"
_CUT = re.compile(r"(?<=\S)(?= \S)")
_LOW = np.int64((1 << 32) - 1)
# Fixed value: the pattern of words of byte-level BPE files that have no pattern of their own.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_RANKED = 1 << 16  # longer texts go to the first library, whose time does not grow with the square of a word's length

_PACK = "shard int, flush bigint, pairs binary, counts binary"
_COUNTED = "shard int, n bigint, levels array<binary>, pairs binary, counts binary, best binary"
_ALIGNED = (
    "doc_id bigint, key bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
    "groups_sha256 string"
)


def units(text: str) -> list[str]:
    """A space and the text, cut before single spaces between other characters."""
    return _CUT.split(" " + text)


class Tokenizers:
    """Both tokenizers, their tokens' bytes, and the lengths of these."""

    _by_path: dict[tuple[str, str], Tokenizers] = {}

    @classmethod
    def at(cls, path_a: str, path_b: str) -> Tokenizers:
        if (path_a, path_b) not in cls._by_path:
            cls._by_path[path_a, path_b] = cls(path_a, path_b)
        return cls._by_path[path_a, path_b]

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import json

        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        with open(path_a, encoding="utf-8") as file:
            described = json.load(file)
        cutter = described["pre_tokenizer"] or {}
        if described["normalizer"] or cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space") or not cutter["use_regex"]:
            raise ValueError(f"{path_a} does not cut words as a byte-level BPE does")
        byte = {letter: b for b, letter in _byte_letters().items()}
        vocabulary = described["model"]["vocab"] | {t["content"]: t["id"] for t in described["added_tokens"]}
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            self.bytes_a[k] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()

        # Where bytes come first and ids stand in the order of merges, as is usual, ids are ranks, and a library that only
        # needs ranks gives the same ids in a quarter of the time.
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in described["model"]["merges"]]
        self._ranked = None
        if all(vocabulary[token] == 256 + k for k, token in enumerate(merged)) and {len(x) for x in self.bytes_a[:256]} == {1}:
            ranks = {self.bytes_a[k]: k for k in range(256 + len(merged))}
            self._ranked = tiktoken.Encoding("a", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})

        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self._b.id_to_piece(k) for k in range(self._b.get_piece_size())]
        if any("▁" in piece.lstrip("▁") for piece in pieces) or "".join(self._b.encode(" a  b ", out_type=str)) != "▁▁a▁▁b▁":
            raise ValueError(f"{path_b} has pieces across words or changes its text")
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self._b.is_byte(k) else piece.replace("▁", " ").encode()
            for k, piece in enumerate(pieces)
        ]
        self.length_a, self.length_b = (np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b))

    def encoded(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both for texts that begin with a space (B adds its own)."""
        if self._ranked and max(map(len, texts), default=0) <= _RANKED:
            a = [self._ranked.encode_ordinary(text) for text in texts]
        else:
            a = [code.ids for code in self._a.encode_batch_fast(texts, add_special_tokens=False)]
        return a, self._b.encode([text[1:] for text in texts], num_threads=1)


@dataclass
class Aligned:
    """Units with their tokens, groups and links; units that are not given back byte for byte have none."""

    sound: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    pairs: np.ndarray  # a link's ids, A's in the upper half, by unit
    groups: list[str] | None


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Neighbouring texts that may stand in one text: (first, last) places. A unit that begins or ends with more white
    space than its first blank stands alone."""
    first = 0
    for k, text in enumerate(texts):
        alone = text[1:2].isspace() or text[-1].isspace()
        if alone or k - first == _TOGETHER:
            if first < k:
                yield first, k
            first = k
        if alone:
            yield k, k + 1
            first = k + 1
    if first < len(texts):
        yield first, len(texts)


def _encoded(texts: list[str], whole: list[bytes], tokenizers: Tokenizers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of A and of B for all texts behind each other, and which texts are given back; the others have no ids. Units are
    encoded many at a time, as neither tokenizer has tokens across their ends."""
    sound = np.ones(len(texts), bool)

    def ids(places: list[tuple[int, int]]) -> Iterator[tuple[list[int], list[int]]]:
        pairs = tokenizers.encoded(["".join(texts[x:y]) for x, y in places])
        for (x, y), a, b in zip(places, *pairs, strict=True):
            given = b"".join(whole[x:y])
            if all(b"".join(map(table.__getitem__, own)) == given for own, table in ((a, tokenizers.bytes_a), (b, tokenizers.bytes_b))):
                yield a, b
            elif y - x > 1:
                yield from ids([(k, k + 1) for k in range(x, y)])
            else:
                sound[x] = False

    found = list(ids(list(_chunks(texts))))
    flat = [np.fromiter(chain.from_iterable(own[side] for own in found), np.int64) for side in (0, 1)]
    return *flat, sound


def aligned(texts: list[str], tokenizers: Tokenizers, named: bool) -> Aligned:
    """The alignment of each text, `named` with its groups spelled out."""
    whole = [text.encode() for text in texts]
    ids_a, ids_b, sound = _encoded(texts, whole, tokenizers)
    # All units stand behind each other on one line of bytes; unit ends are ends of tokens of both.
    end_a, end_b = np.cumsum(tokenizers.length_a[ids_a]), np.cumsum(tokenizers.length_b[ids_b])
    start_a, start_b = end_a - tokenizers.length_a[ids_a], end_b - tokenizers.length_b[ids_b]
    common = np.intersect1d(end_a, end_b, assume_unique=True)
    sizes = np.array([len(x) for x in whole], np.int64) * sound
    ends = np.cumsum(sizes)
    within = lambda marks: np.searchsorted(marks, ends, "right") - np.searchsorted(marks, ends - sizes, "right")
    n_a, n_b, n_groups = within(end_a), within(end_b), within(common)
    first = np.searchsorted(end_b, start_a, "right")
    times = np.searchsorted(start_b, end_a, "left") - first
    at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    pairs = (np.repeat(ids_a, times) << 32) | ids_b[np.repeat(first, times) + at]
    before = np.concatenate(([0], np.cumsum(times)))
    last_a = np.cumsum(n_a)
    n_links = before[last_a] - before[last_a - n_a]
    groups = None
    if named:
        group = np.concatenate((np.searchsorted(common, end_a, "left"), np.searchsorted(common, end_b, "left")))
        side = np.concatenate((np.zeros(len(ids_a), np.int8), np.ones(len(ids_b), np.int8)))
        order = np.argsort(group * 2 + side, kind="stable")
        step = np.diff((group * 2 + side)[order], append=-2)
        mark = np.where(step == 0, ",", np.where(side[order] == 0, "|", ";")).tolist()
        parts = [f"{k}{m}" for k, m in zip(np.concatenate((ids_a, ids_b))[order].tolist(), mark, strict=True)]
        ends_ = np.cumsum(n_a + n_b).tolist()
        starts = (np.cumsum(n_a + n_b) - n_a - n_b).tolist()
        groups = ["".join(parts[x:y])[:-1] for x, y in zip(starts, ends_, strict=True)]
    return Aligned(sound, n_a, n_b, n_groups, n_links, pairs, groups)


def _split(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Units of texts without their first blank, and how many each text has; NULL and empty texts have none."""
    alone = pc.or_(pc.equal(texts, ""), pc.match_substring_regex(texts, _SPACED))
    odd = np.flatnonzero(pc.fill_null(alone, False).to_numpy(zero_copy_only=False))
    first = 0
    for k in [*odd.tolist(), len(texts)]:
        if first < k:
            split = pc.split_pattern(texts.slice(first, k - first), " ")
            yield split.flatten(), pc.fill_null(split.value_lengths(), 0).to_numpy().astype(np.int64)
        if k < len(texts):
            text = texts[k].as_py()
            own = [unit[1:] for unit in units(text)] if text else []
            yield pa.array(own, pa.string()), np.array([len(own)], np.int64)
        first = k + 1


def flushes(given: Iterator[pa.RecordBatch], paths: tuple[str, str], named: bool) -> Iterator[tuple]:
    """Documents of a task in flushes: (doc_ids, keys, which unit stands at each place, number of places per document, the
    alignment of the units). Documents with a unit that is not given back have none, unless the whole is given back all the
    same: then it is one unit."""
    tokenizers = Tokenizers.at(*paths)

    def done():
        coded = pa.chunked_array(words, pa.string()).combine_chunks().dictionary_encode()
        texts = [" " + word for word in coded.dictionary.to_pylist()]
        which, sizes = coded.indices.to_numpy().astype(np.int64), np.concatenate(counts)
        found = aligned(texts, tokenizers, named)
        if not found.sound.all():
            document = np.repeat(np.arange(len(sizes)), sizes)
            bad = np.unique(document[~found.sound[which]])
            starts = (np.cumsum(sizes) - sizes)[bad]
            wholes = ["".join([texts[x] for x in which[y : y + n].tolist()]) for y, n in zip(starts, sizes[bad], strict=True)]
            more = aligned(wholes, tokenizers, named)
            keep = ~np.isin(document, bad)
            keep[starts] = True
            which[starts] = len(texts) + np.arange(len(bad))
            which, sizes[bad] = which[keep], 1
            names = ("sound", "n_a", "n_b", "n_groups", "n_links", "pairs")
            joined = {name: np.concatenate((getattr(found, name), getattr(more, name))) for name in names}
            found = Aligned(**joined, groups=found.groups + more.groups if named else None)
        return pa.chunked_array(ids, pa.int64()), pa.chunked_array(keys, pa.int64()), which, sizes, found

    words, counts, ids, keys, total = [], [], [], [], 0
    for batch in given:
        for k in range(0, len(batch), _DOCUMENTS):
            part = batch.slice(k, _DOCUMENTS)
            ids.append(part.column("doc_id"))
            keys.append(part.column("key"))
            for own, sizes in _split(part.column("text")):
                words.append(own)
                counts.append(sizes)
                total += len(own) + len(sizes)
            if total >= _HELD:
                yield done()
                words, counts, ids, keys, total = [], [], [], [], 0
    if ids:
        yield done()


class Numbering:
    """A minimal perfect hash of different 64-bit keys: bits of the settled places, level by level."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        counts = np.cumsum([0] + [int(bits.sum()) for bits in levels])
        self.ranks = [np.cumsum(bits, dtype=np.int32) - 1 + base for bits, base in zip(levels, counts, strict=False)]

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(keys.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> Numbering:
        levels = []
        while len(keys):
            size = -(-max(64, 2 * len(keys)) // 8) * 8
            at = cls._places(keys, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for some keys that are not among those numbered, any number for others."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = self._places(keys[left], level, len(bits))
            settled = bits[at]
            out[left[settled]] = ranks[at[settled]]
            left = left[~settled]
        return out

    def packed(self) -> list[bytes]:
        return [np.packbits(bits).tobytes() for bits in self.levels]

    @classmethod
    def unpacked(cls, levels: list[bytes]) -> Numbering:
        return cls([np.unpackbits(np.frombuffer(x, np.uint8)).astype(bool) for x in levels])


class Counts:
    """Look-up of pairs in the counted shards of a broadcast."""

    def __init__(self, shards: list[tuple]):
        self._shards = {
            shard: (Numbering.unpacked(levels), np.frombuffer(pairs, np.int64), np.frombuffer(counts, np.int64), np.frombuffer(marks, bool))
            for shard, levels, pairs, counts, marks in shards
        }

    def of(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and mark of each pair; zeros for pairs of shards that are not here."""
        counts, marks = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        shards = _shard(pairs)
        order = np.argsort(shards, kind="stable")
        for a, b in _runs(shards[order]):
            at = order[a:b]
            if int(shards[at[0]]) in self._shards:
                numbering, keys, own, best = self._shards[int(shards[at[0]])]
                number = numbering.numbers(pairs[at])
                if (number < 0).any() or (keys[number] != pairs[at]).any():
                    raise ValueError("a pair was not counted: the documents changed between the passes")
                counts[at], marks[at] = own[number], best[number]
        return counts, marks


def _shard(pairs: np.ndarray) -> np.ndarray:
    return (pairs & _LOW) % SHARDS


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """First place and end of every run of equal neighbours; no value is -1."""
    starts = np.flatnonzero(np.diff(values, prepend=-1)).tolist()
    return list(zip(starts, [*starts[1:], len(values)], strict=False))


def _added(pairs: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs and the sums of their weights."""
    order = np.argsort(pairs, kind="stable")
    pairs, weights = pairs[order], weights[order]
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    return pairs[first], np.add.reduceat(weights, first) if len(first) else weights


def _packs(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """The different pairs of each flush with their counts, a row for each shard."""

    def count(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        flush = TaskContext.get().partitionId() << 20
        for _, _, which, _, found in flushes(given, paths, named=False):
            times = np.bincount(which, minlength=len(found.sound))
            pairs, counts = _added(found.pairs, np.repeat(times, found.n_links))
            pairs, counts = pairs[counts > 0], counts[counts > 0]
            order = np.argsort(_shard(pairs), kind="stable")
            pairs, counts = pairs[order], counts[order]
            shards = _shard(pairs)
            cuts = _runs(shards)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shards[a] for a, _ in cuts], pa.int32()),
                    pa.array([flush] * len(cuts), pa.int64()),
                    pa.array([pairs[a:b].tobytes() for a, b in cuts], pa.binary()),
                    pa.array([counts[a:b].tobytes() for a, b in cuts], pa.binary()),
                ],
                names=["shard", "flush", "pairs", "counts"],
            )
            flush += 1

    return docs.mapInArrow(count, _PACK)


def _joined(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64)


def _numbered(packs: DataFrame) -> DataFrame:
    """(shard, n, levels, pairs): the minimal perfect hash of each shard and its pairs in the order of their numbers."""

    def different(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "pairs": [np.unique(_joined(group.column("pairs"))).tobytes()]})

    def number(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        pairs = np.unique(_joined(group.column("pairs")))
        numbering = Numbering.of(pairs)
        placed = np.empty_like(pairs)
        placed[numbering.numbers(pairs)] = pairs
        columns = {"n": pa.array([len(pairs)]), "levels": pa.array([numbering.packed()], pa.list_(pa.binary())), "pairs": [placed.tobytes()]}
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), **columns})

    sliced = packs.select("shard", "slice", "pairs").groupBy("shard", "slice")
    once = sliced.applyInArrow(different, "shard int, pairs binary")
    return once.groupBy("shard").applyInArrow(number, "shard int, n bigint, levels array<binary>, pairs binary")


def _counted(packs: DataFrame, numbered: DataFrame, slices: int) -> DataFrame:
    """numbered with the count of each pair and whether it is the highest of its B id."""

    def dense(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        shard = pa.array([key[0].as_py()] * (len(left) > 0), pa.int32())
        if not len(left):
            return pa.table({"shard": shard, "counts": pa.array([], pa.binary())})
        numbering = Numbering.unpacked(right.column("levels")[0].as_py())
        total = np.zeros(right.column("n")[0].as_py(), np.int64)
        for pairs, counts in zip(left.column("pairs"), left.column("counts"), strict=True):
            total[numbering.numbers(np.frombuffer(pairs.as_py(), np.int64))] += np.frombuffer(counts.as_py(), np.int64)
        return pa.table({"shard": shard, "counts": pa.array([total.tobytes()], pa.binary())})

    def whole(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        total = np.zeros(right.column("n")[0].as_py(), np.int64)
        for counts in left.column("counts"):
            total += np.frombuffer(counts.as_py(), np.int64)
        pairs = np.frombuffer(right.column("pairs")[0].as_py(), np.int64)
        order = np.argsort(pairs & _LOW, kind="stable")
        own = (pairs & _LOW)[order]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        highest = np.repeat(np.maximum.reduceat(total[order], first), np.diff(np.append(first, len(own))))
        marks = np.zeros(len(total), bool)
        marks[order] = total[order] == highest
        return right.append_column("counts", [[total.tobytes()]]).append_column("best", [[marks.tobytes()]])

    every = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<bigint>")).alias("slice")
    spread = numbered.select("shard", every, "n", "levels")
    partial = packs.groupBy("shard", "slice").cogroup(spread.groupBy("shard", "slice")).applyInArrow(dense, "shard int, counts binary")
    return partial.groupBy("shard").cogroup(numbered.groupBy("shard")).applyInArrow(whole, _COUNTED)


def _looked_up(docs: DataFrame, paths: tuple[str, str], shards: list[tuple]) -> DataFrame:
    """One row per document, its sums over the pairs of the given shards."""
    sent = docs.sparkSession.sparkContext.broadcast(shards)

    def look(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Counts(sent.value)
        for ids, keys, which, sizes, found in flushes(given, paths, named=True):
            # Units of texts that are not given back may hold pairs that no document counts.
            used = np.repeat(np.bincount(which, minlength=len(found.sound)) > 0, found.n_links)
            counts, marks = np.zeros((2, len(used)), np.int64)
            counts[used], marks[used] = table.of(found.pairs[used])
            link_ends = np.cumsum(found.n_links)
            per_unit = [found.n_a, found.n_b, found.n_groups, found.n_links]
            for values in (marks, counts):
                sums = np.concatenate(([0], np.cumsum(values)))
                per_unit.append(sums[link_ends] - sums[link_ends - found.n_links])
            ends = np.cumsum(sizes)
            totals = []
            for values in per_unit:
                sums = np.concatenate(([0], np.cumsum(values[which])))
                totals.append(sums[ends] - sums[ends - sizes])
            digests = []
            for a, b, n in zip((ends - sizes).tolist(), ends.tolist(), totals[0].tolist(), strict=True):
                text = ";".join([found.groups[k] for k in which[a:b].tolist()]) if n else ""
                digests.append(hashlib.sha256(text.encode()).hexdigest() if n else "")
            columns = [ids.combine_chunks(), keys.combine_chunks(), *map(pa.array, totals), pa.array(digests)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _ALIGNED.split(", ")])

    return docs.mapInArrow(look, _ALIGNED)


def _rounds(counted: DataFrame) -> Iterator[list[int]]:
    """Shards whose pairs are at most SLICE together, or one shard."""
    held, total = [], 0
    for shard, n in sorted(tuple(r) for r in counted.select("shard", "n").collect()):
        if held and total + n > SLICE:
            yield held
            held, total = [], 0
        held.append(shard)
        total += n
    yield held


def aligned_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    paths = (path_a, path_b)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key(F.col("text")).alias("key"), "text")
    packs = stored(_packs(rows, paths), "pairs")
    # Shards of one flush are its rows; what a slice sums is at most FAN flushes.
    slices = max(1, -(-packs.select("flush").distinct().count() // FAN))
    sliced = packs.withColumn("slice", F.pmod(F.xxhash64("flush"), F.lit(slices)))
    numbered = stored(_numbered(sliced), "numbered")
    counted = stored(_counted(sliced, numbered, slices), "counted")
    total = None
    for shards in _rounds(counted):
        part = counted.where(F.col("shard").isin(shards)).select("shard", "levels", "pairs", "counts", "best")
        found = _looked_up(rows, paths, [(r[0], [bytes(x) for x in r[1]], *map(bytes, r[2:])) for r in part.collect()])
        if total is None:
            total = found
            continue
        # Copies of a row have equal sums: one of them is added to each.
        more = found.select("doc_id", "key", F.col("n_best").alias("b"), F.col("count_sum").alias("c"))
        more = more.dropDuplicates(["doc_id", "key"]).withColumnsRenamed({"doc_id": "i", "key": "k"})
        same = total["doc_id"].eqNullSafe(more["i"]) & (total["key"] == more["k"])
        added = {"n_best": F.col("n_best") + F.col("b"), "count_sum": F.col("count_sum") + F.col("c")}
        total = total.join(more, same).withColumns(added).drop("i", "k", "b", "c")
    done = total.drop("key")
    discarded(packs, numbered, counted)
    return done
