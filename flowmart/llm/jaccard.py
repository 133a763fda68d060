"""N-gram Jaccard join: which documents are linked, directly or by others, by word shingles that are similar enough.

Two documents link when 100 * |A and B| >= 80 * |A or B| for their sets of five-word shingles. No pair of documents is
compared that shares no index key, no link between different sets is lost, and copies of a set stand in for each other.

Shingles are 64-bit hashes; the order of the hashes is the global order of tokens. With n tokens, a partner holds at
least r = ceil(0.8 n) of them, so of the first n - r + k tokens (the prefix, extended by k) at least k are shared, and
they are in the partner's extended prefix too. That is used three times:

1. Candidates: of its prefix extended by k = ceil(0.2 n), a document must share k tokens with any other documents. Tasks
   send every token once, however many of their documents hold it, so a frequent token is a few rows per task. Only
   documents that pass are looked at again, one for each set.
2. Index: tokens of the plain prefix (k = 1) that few candidates hold are keys by themselves. If a frequent token is in a
   document's prefix, the document is also indexed by combinations of two tokens that are neighbours in its first 0.45 n + 2
   tokens. Two linked sets have at most n / 4 tokens that are not shared, at most n / 5 of them in the one with n; so
   among the first n / 4 + 2 shared tokens some two are neighbours in both.
3. Verification: members of an index list are compared by their whole sets with one member (later a slice of some, dealt
   by hash), not all with all. What is linked by then is one component and needs no more comparing; lists whose members are in
   different components go on, until every pair that shares a key is in one component or has been compared. Pairs share many keys:
   they come first from a few of the lists, and once compared they are left out where they meet again.

Documents without words have an empty set and are linked with nothing. NULL texts count as empty. Rows with equal doc_id
and text are one document and get equal rows. NULL doc_ids are documents too, but an id is reported as the smallest only
among those that have one. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmart.llm.common import discarded, released, row_key, stored
from flowmart.llm.hashing import batches, hashed_words, mixed, windows
from flowmart.workspace import written

SHINGLE = 5
PERCENT = 80
RARE = 32
FLUSH = 1 << 19  # tokens that a task gathers before it sends them
_PER_BUCKET = 1 << 20  # tokens of a bucket of the first step
_LEAST_BITS = 6
_CENTRES = 32  # members of a list's slice
_BITS = [f"b{k}" for k in range(8)]
_RANKS = 1 << 30
_SOME = 16  # one list of so many gives the first pairs


def required(n: np.ndarray) -> np.ndarray:
    """Tokens of n that any partner holds at least: ceil(n * PERCENT / 100)."""
    return -(-n * PERCENT // 100)


def _sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, ordered by document and hash: tokens, their documents, tokens per document."""
    w = hashed_words(texts, lower=True)
    at = np.arange(max(0, len(w.hashes) - SHINGLE + 1))
    grams = windows(w.hashes, SHINGLE)
    inside = w.doc[at] == w.doc[at + SHINGLE - 1]
    tokens, doc = grams[inside], w.doc[at][inside]
    short = np.flatnonzero((w.counts > 0) & (w.counts < SHINGLE))
    if len(short):  # the whole sequence is the one shingle; its length tells it apart from longer ones
        first = w.first
        own = [mixed(windows(w.hashes[first[k] : first[k] + w.counts[k]], int(w.counts[k])) + w.counts[k].astype(np.uint64)) for k in short]
        tokens, doc = np.concatenate([tokens, *own]), np.concatenate([doc, short])
    order = np.lexsort((tokens, doc))
    tokens, doc = tokens[order], doc[order]
    if len(tokens):
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (doc[1:] != doc[:-1])
        tokens, doc = tokens[new], doc[new]
    return tokens, doc, np.bincount(doc, minlength=len(texts)).astype(np.int64)


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _heads(counts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Of tokens ordered by document, which are among the first `wanted` of their document."""
    first = np.cumsum(counts) - counts
    return np.arange(counts.sum()) - np.repeat(first, counts) < np.repeat(wanted, counts)


def _prefix(docs: DataFrame, bits: int) -> DataFrame:
    """Rows of two kinds. bucket < 0: a document (ref, doc_id, key, n, s1, s2, credit). Otherwise the tokens of a task
    within a bucket: the low 40 bits of each as `tokens`, and as `refs` the document (counted from ref), or -1 when more
    than one document of the task holds the token: those documents have their credit already."""

    def emit(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ref = TaskContext.get().partitionId() << 36
        held: list = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, ref
            ids, keys = pa.concat_arrays([h[0] for h in held]), pa.concat_arrays([h[1] for h in held])
            counts, s1, s2 = (np.concatenate([h[k] for h in held]) for k in (2, 3, 4))
            tokens = np.concatenate([h[5] for h in held])
            bases = np.cumsum([0] + [len(h[2]) for h in held[:-1]])
            doc = np.concatenate([h[6] + base for h, base in zip(held, bases, strict=True)])
            order = np.argsort(tokens, kind="stable")
            tokens, doc = tokens[order], doc[order]
            first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1]))) if len(tokens) else np.zeros(0, int)
            times = np.diff(np.append(first, len(tokens)))
            credit = np.bincount(doc[np.repeat(times, times) > 1], minlength=len(counts))
            n = len(counts)
            yield _rows(
                bucket=np.full(n, -1), ref=ref + np.arange(n), doc_id=ids, key=keys, n=counts, s1=s1, s2=s2, credit=credit
            )
            tokens, doc = tokens[first], np.where(times > 1, -1, doc[first]).astype(np.int32)
            bucket = (tokens >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(tokens), np.int64)
            low = (tokens >> np.uint64(24 - bits)) & np.uint64((1 << 40) - 1)
            packed = low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            starts, ends = np.append(0, cuts), np.append(cuts, len(tokens))
            if len(tokens):
                yield _rows(
                    bucket=bucket[starts],
                    ref=np.full(len(starts), ref),
                    tokens=[packed[a:b].tobytes() for a, b in zip(starts, ends, strict=True)],
                    refs=[doc[a:b].tobytes() for a, b in zip(starts, ends, strict=True)],
                )
            ref += n
            held = []

        gathered = 0
        for batch in given:
            texts = _texts(batch.column("text"))
            for a, b in batches(texts):
                tokens, doc, counts = _sets(texts[a:b])
                missing = counts - required(counts)
                head = _heads(counts, missing + np.maximum(1, missing))
                # Two sums stand for the set: equal sets have equal sums.
                edges = np.cumsum(counts) - counts
                total = lambda x: np.where(counts > 0, np.add.reduceat(np.append(x, np.uint64(0)), np.minimum(edges, len(x))), 0)  # noqa: E731, B023
                held.append(
                    (
                        batch.column("doc_id").slice(a, b - a),
                        batch.column("key").slice(a, b - a),
                        counts,
                        total(mixed(tokens)).astype(np.uint64).view(np.int64),
                        total(mixed(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5))).astype(np.uint64).view(np.int64),
                        tokens[head],
                        doc[head],
                    )
                )
                gathered += int(head.sum()) + b - a
                if gathered >= FLUSH:
                    yield from flush()
                    gathered = 0
        if held:
            yield from flush()

    return docs.mapInArrow(emit, _ROWS)


_ROWS = (
    "bucket bigint, ref bigint, doc_id bigint, key bigint, n bigint, s1 bigint, s2 bigint, credit bigint, "
    "tokens binary, refs binary"
)
_TYPES = {"tokens": pa.binary(), "refs": pa.binary()}


def _rows(**columns) -> pa.RecordBatch:
    length = len(columns["ref"])
    names = [c.split()[0] for c in _ROWS.split(", ")]
    arrays = []
    for name in names:
        kind = _TYPES.get(name, pa.int64())
        value = columns.get(name)
        arrays.append(pa.nulls(length, kind) if value is None else value if isinstance(value, pa.Array) else pa.array(value, kind))
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _credits(rows: DataFrame) -> DataFrame:
    """(ref, more): for documents, tokens that other documents of other tasks hold. A bucket gets each token at most
    once from a task, so its size follows the number of tasks, not that of a token's documents. What buckets find goes
    back packed, one row for the documents that were sent together, and is added up there."""

    def count(group: pa.Table) -> pa.Table:
        packs = group.column("tokens").to_pylist()
        tokens = np.frombuffer(b"".join(packs), np.uint8).reshape(-1, 5)
        wide = np.zeros((len(tokens), 8), np.uint8)
        wide[:, :5] = tokens
        value = wide.view("<u8").ravel()
        bases = group.column("ref").to_numpy()
        local = np.frombuffer(b"".join(group.column("refs").to_pylist()), np.int32)
        pack = np.repeat(np.arange(len(packs), dtype=np.int32), [len(p) // 5 for p in packs])
        del tokens, packs
        order = np.argsort(value, kind="stable")
        value = value[order]
        same = np.zeros(len(value), bool)
        equal = value[1:] == value[:-1]
        same[1:] |= equal
        same[:-1] |= equal
        found = order[same]
        found = found[local[found] >= 0]
        who, times = np.unique(bases[pack[found]] + local[found], return_counts=True)
        starts = np.unique(bases)
        cuts = np.append(np.searchsorted(who, starts), len(who))
        sent = [(base, who[a:b], times[a:b]) for base, a, b in zip(starts, cuts, cuts[1:], strict=False) if b > a]
        return pa.table(
            {
                "base": pa.array([base for base, _, _ in sent], pa.int64()),
                "places": pa.array([(w - base).astype(np.int32).tobytes() for base, w, _ in sent], pa.binary()),
                "times": pa.array([t.astype(np.int32).tobytes() for _, _, t in sent], pa.binary()),
            }
        )

    def add(group: pa.Table) -> pa.Table:
        places = np.frombuffer(b"".join(group.column("places").to_pylist()), np.int32)
        times = np.frombuffer(b"".join(group.column("times").to_pylist()), np.int32)
        total = np.bincount(places, times).astype(np.int64)
        held = np.flatnonzero(total)
        return pa.table({"ref": pa.array(held + group.column("base")[0].as_py()), "more": pa.array(total[held])})

    packs = rows.where("bucket >= 0").select("bucket", "ref", "tokens", "refs")
    counted = packs.groupBy("bucket").applyInArrow(count, "base bigint, places binary, times binary")
    return counted.groupBy("base").applyInArrow(add, "ref bigint, more bigint")


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n, s1, s2, candidate) per row of docs; written. s1 and s2 stand for the set."""
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    # A shingle per six characters, 0.4 of them in the prefix.
    bits = max(_LEAST_BITS, int(size / 14 / _PER_BUCKET).bit_length())
    rows = stored(_prefix(docs, min(bits, 20)), "prefixes")
    one = rows.where("bucket < 0").select("ref", "doc_id", "key", "n", "s1", "s2", "credit")
    credit = F.col("credit") + F.coalesce("more", F.lit(0))
    # The smallest partner has r tokens and so the shortest extension; its first shared tokens are in both prefixes.
    least = F.ceil(F.col("n") * PERCENT / 100)
    missing = least - F.ceil(least * PERCENT / 100)
    passes = (F.col("n") > 0) & (credit >= F.greatest(missing, F.lit(1)))
    named = one.join(_credits(rows), "ref", "left").select("doc_id", "key", "n", "s1", "s2", passes.alias("candidate"))
    done = written(named, "described")
    discarded(rows)
    return done


def _parity(tokens: np.ndarray, doc: np.ndarray, texts: int) -> np.ndarray:
    """For each text 64 bits a column: whether an odd number of its tokens fall on the bit. Where two sets differ in a
    bit they differ in at least one token of their own, so the number of such bits never exceeds that of tokens."""
    size = 64 * len(_BITS)
    at = (tokens >> np.uint64(7)) % np.uint64(size)
    odd = (np.bincount(doc * size + at.astype(np.int64), minlength=texts * size) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(texts, size), axis=1).view("<i8")


def token_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set_id, n, tokens, b0, b1, ...): the sorted tokens of the wanted (set_id, doc_id, key), read from one row each, and
    their parity bits; written."""

    def build(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            texts = _texts(batch.column("text"))
            for a, b in batches(texts):
                tokens, doc, counts = _sets(texts[a:b])
                offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("set_id").slice(a, b - a),
                        pa.array(counts),
                        pa.ListArray.from_arrays(offsets, pa.array(tokens.view(np.int64))),
                        *[pa.array(bits) for bits in _parity(tokens, doc, b - a).T],
                    ],
                    names=["set_id", "n", "tokens", *_BITS],
                )

    same = docs["doc_id"].eqNullSafe(wanted["doc_id"]) & (docs["key"] == wanted["key"])
    rows = docs.join(wanted, same).select(wanted["set_id"], docs["text"])
    bits = ", ".join(f"{name} bigint" for name in _BITS)
    built = rows.mapInArrow(build, f"set_id bigint, n bigint, tokens array<bigint>, {bits}")
    sets = written(built, "sets")
    # Copies of a row bring their set again.
    again = sets.groupBy("set_id").count().where("count > 1").limit(1).count()
    return written(sets.dropDuplicates(["set_id"]), "sets") if again else sets


def _required():
    return F.ceil(F.col("n") * PERCENT / 100)


def index_lists(sets: DataFrame) -> DataFrame:
    """(token, second, set_id, n, c): the members of every index list with two or more members; written. `second` is NULL
    for lists of a single rare token, else the other token of a combination; c is the number of common tokens of the set.

    The order of tokens is now by how many candidates hold them, then by hash. Tokens that one candidate holds come first
    and are never shared, so a set needs as many common ones as a partner must share at least.
    """
    each = sets.select("set_id", F.explode("tokens").alias("token"))
    counts = each.groupBy("token").agg(F.count("*").alias("times")).where("times > 1")
    common = each.join(counts, "token").groupBy("set_id").agg(F.array_sort(F.collect_list(F.struct("times", "token"))).alias("t"))
    able = common.join(sets.select("set_id", "n"), "set_id").withColumn("required", _required())
    able = able.where(F.size("t") >= F.col("required")).withColumn("alone", F.col("n") - F.size("t"))
    head = F.slice("t", F.lit(1), (F.size("t") - F.col("required") + 1).cast("int"))
    reach = F.greatest(F.lit(2), F.ceil(F.col("n") * 0.45 + 2) - 2 * F.col("alone")).cast("int")
    pair = lambda i: F.struct(F.get("near", i)["token"].alias("token"), F.get("near", i + 1)["token"].alias("second"))
    none = F.lit(None).cast("bigint")
    rare = F.filter("head", lambda x: x["times"] <= RARE)
    single = F.transform(rare, lambda x: F.struct(x["token"].alias("token"), none.alias("second")))
    pairs = F.when(
        (F.size(rare) < F.size("head")) & (F.size("near") > 1), F.transform(F.sequence(F.lit(0), F.size("near") - 2), pair)
    ).otherwise(F.array().cast("array<struct<token: bigint, second: bigint>>"))
    ready = able.select("set_id", "n", F.size("t").alias("c"), head.alias("head"), F.slice("t", F.lit(1), reach).alias("near"))
    keys = written(ready.select(F.inline(F.concat(single, pairs)), "set_id", "n", "c"), "keys")
    twice = keys.groupBy("token", "second").count().where("count > 1").select("token", "second")
    same = (F.col("k.token") == F.col("t.token")) & F.col("k.second").eqNullSafe(F.col("t.second"))
    return written(keys.alias("k").join(twice.alias("t"), same, "left_semi"), "lists")


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of set ids whose sets are similar enough; written. Each set is compared with a few others, and
    the two sides meet row by row: no group of sets is gathered."""

    def verify(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            sides = []
            for name in ("ta", "tb"):
                column = batch.column(name)
                sides.append((column.offsets.to_numpy(), column.values.to_numpy()))
            (oa, va), (ob, vb) = sides
            good = np.zeros(len(batch), bool)
            for k in range(len(batch)):
                x, y = va[oa[k] : oa[k + 1]], vb[ob[k] : ob[k + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                good[k] = 100 * both >= PERCENT * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    left = sets.select(F.col("set_id").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("set_id").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(left, "a").join(right, "b")
    return written(both.select("a", "b", "ta", "tb").mapInArrow(verify, "a bigint, b bigint"), "links")


def components(links: DataFrame, labels: DataFrame) -> DataFrame:
    """(set_id, label): labels after joining the components that links connect; written. Every round hands each
    component the least label of its neighbours and then of that label's own, until none changes."""
    edges = written(
        links.join(labels.select(F.col("set_id").alias("a"), F.col("label").alias("la")), "a")
        .join(labels.select(F.col("set_id").alias("b"), F.col("label").alias("lb")), "b")
        .where("la <> lb")
        .select(F.least("la", "lb").alias("low"), F.greatest("la", "lb").alias("high"))
        .distinct(),
        "edges",
    )
    both = edges.select(F.col("high").alias("x"), F.col("low").alias("y")).union(edges.select("low", "high"))
    ends = both.select("x").distinct()
    state = written(ends.select("x", F.col("x").alias("root")), "roots")
    while True:
        near = both.join(state.select(F.col("x").alias("y"), "root"), "y").groupBy("x").agg(F.min("root").alias("near"))
        lower = state.join(near, "x").select("x", "root", F.least("root", "near").alias("next"))
        jump = lower.select(F.col("x").alias("next"), F.col("next").alias("far"))
        moved = lower.join(jump, "next", "left").select("x", F.coalesce("far", "next").alias("next"), F.col("root").alias("old"))
        moved = written(moved, "roots")
        changed = moved.where("next <> old").limit(1).count()
        state = moved.select("x", F.col("next").alias("root"))
        if not changed:
            break
    renamed = labels.join(state, labels["label"] == state["x"], "left")
    return written(renamed.select("set_id", F.coalesce("root", "label").alias("label")), "labels")


def _alike(x: str, y: str):
    """Sizes and numbers of common tokens that leave a link possible: two sets share common tokens at most."""
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    shared = F.least(F.col(f"{x}.c"), F.col(f"{y}.c"))
    return shared * (100 + PERCENT) >= (nx + ny) * PERCENT


def _same_list(x: str, y: str):
    return (F.col(f"{x}.token") == F.col(f"{y}.token")) & F.col(f"{x}.second").eqNullSafe(F.col(f"{y}.second"))


def _star_pairs(lists: DataFrame) -> DataFrame:
    """Every member of a list with its least member."""
    centre = lists.groupBy("token", "second").agg(F.min(F.struct("set_id", "n", "c")).alias("first")).select("token", "second", "first.*")
    apart = F.col("l.set_id") > F.col("c.set_id")
    return (
        lists.alias("l")
        .join(centre.alias("c"), _same_list("l", "c") & apart & _alike("l", "c"))
        .select(F.col("c.set_id").alias("a"), F.col("l.set_id").alias("b"))
        .distinct()
    )


def _near(x: str, y: str):
    """Linked sets differ in at most a ninth of their tokens, added up; parity bits show a part of the difference."""
    apart = sum(F.bit_count(F.col(f"{x}.{b}").bitwiseXOR(F.col(f"{y}.{b}"))) for b in _BITS)
    return apart * (100 + PERCENT) <= (F.col(f"{x}.n") + F.col(f"{y}.n")) * (100 - PERCENT)


def _partners(now: DataFrame, tested: DataFrame, start: int, width: int) -> DataFrame:
    """(a, b): different pairs of set ids of members of a list in different components, one of them in the slices from start
    on, that their sizes and parity bits allow to be linked and that have not been tested. Of two members, a is the one of
    lower rank, in every list."""
    done = tested.groupBy(F.col("a").alias("set_id")).agg(F.collect_set("b").alias("done"))
    centre = now.where((F.col("slice") >= start) & (F.col("slice") < start + width)).join(done, "set_id", "left")
    rank = lambda x: F.struct(f"{x}.rank", f"{x}.set_id")
    fresh = ~F.coalesce(F.array_contains("c.done", F.col("l.set_id")), F.lit(False))
    apart = (rank("c") < rank("l")) & (F.col("c.label") != F.col("l.label"))
    same = (F.col("c.list_id") == F.col("l.list_id")) & apart & _alike("c", "l") & _near("c", "l") & fresh
    met = centre.alias("c").join(now.alias("l"), same)
    return met.select(F.col("c.set_id").alias("a"), F.col("l.set_id").alias("b")).distinct()


def joined_sets(sets: DataFrame) -> DataFrame:
    """(set_id, label): the component of every set; the label is the least set id."""
    spark = sets.sparkSession
    lists = index_lists(sets)
    released(spark)
    compared = written(_star_pairs(lists), "pairs")
    labels = components(linked(compared, sets), sets.select("set_id", F.col("set_id").alias("label")))
    released(spark)
    several = (
        lists.join(labels, "set_id")
        .groupBy("token", "second")
        .agg(F.min("label").alias("least"), F.max("label").alias("most"), F.count("*").alias("members"))
        .where("least < most")
    )
    # Slices of a list are compared with all its members, one after the other. A set has the same rank in all its lists, so
    # that those that share members choose the same ones first.
    rank = F.pmod(F.xxhash64("set_id"), F.lit(_RANKS))
    slice_ = F.floor(rank * F.ceil(F.col("members") / _CENTRES) / _RANKS)
    placed = written(
        lists.alias("l")
        .join(several.alias("o"), _same_list("l", "o"))
        .select(
            F.xxhash64("l.token", F.col("l.second").isNull(), "l.second").alias("list_id"),
            "set_id", "n", "c", rank.alias("rank"), slice_.alias("slice"),
        ),
        "placed",
    )
    bits = sets.select("set_id", *_BITS)
    # Not made in Python: for rows from there each executor would start workers of another kind, which then stay.
    tested = compared.where(F.lit(False))
    start, width, some = 0, 1, True
    while True:
        current = placed.where(F.col("slice") >= start).join(labels, "set_id")
        lasting = current.groupBy("list_id").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least < most")
        still = current.join(lasting.select("list_id"), "list_id", "left_semi")
        now = written(still.join(bits, "set_id"), "open")
        if now.isEmpty():
            return labels
        chosen = now.where(F.col("list_id") % _SOME == 0) if some else now
        pairs = written(_partners(chosen, tested, start, width), "pairs")
        tested = tested.unionByName(pairs)
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        labels = components(linked(ordered.join(compared, ["a", "b"], "left_anti"), sets), labels)
        released(spark)
        if not some:
            start, width = start + width, width * 4
        some = False


def similarity_classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, key, n_shingles, component_id (the smallest doc_id of all linked documents) and label,
    which all linked documents share, with ids or without; NULL for empty sets."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), row_key(F.col("text")).alias("key"), F.col("text")
    )
    named = described(rows)
    set_key = ["n", "s1", "s2"]
    # One document stands for each set; its number is the least of its rows' and so the same in every run.
    first = F.min(F.struct("doc_id", "key")).alias("first")
    reps = (
        named.where("n > 0").groupBy(*set_key).agg(first, F.min("doc_id").alias("least"), F.max("candidate").alias("candidate"))
    )
    number = F.xxhash64("n", "s1", "s2")
    reps = written(reps.select(*set_key, "first.*", "least", "candidate", number.alias("set_id")), "reps")
    sets = token_sets(rows, reps.where("candidate").select("set_id", "doc_id", "key"))
    released(docs.sparkSession)
    labels = joined_sets(sets)
    labelled = reps.join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = written(labelled.join(smallest, "label").select(*set_key, "component_id", "label"), "classes")
    return (
        named.join(classes, set_key, "left")
        .select(
            "doc_id", "key", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "label"
        )
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of docs, all their columns, with one document left of each component: that with the smallest doc_id, ids
    before none, of equal ones that with the least key, and one of rows with equal doc_id and text."""
    each = similarity_classes(docs).groupBy("label", "doc_id", "key").count()
    # An empty set is linked with nothing.
    alone = F.when(F.col("label").isNull(), F.struct("doc_id", "key")).alias("alone")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "count")).alias("first")
    chosen = each.groupBy("label", alone).agg(first).select("first.doc_id", "first.key", "first.count")
    chosen = written(chosen, "chosen")
    given = docs.select(F.struct("*").alias("_given"), F.col("doc_id"), row_key(F.col("text")).alias("_key"))
    same = given["doc_id"].eqNullSafe(chosen["doc_id"]) & (given["_key"] == chosen["key"])
    kept = given.join(chosen, same, "left_semi")
    copies = chosen.where("count > 1").limit(1).count()
    return (kept.dropDuplicates(["doc_id", "_key"]) if copies else kept).select("_given.*")
