"""Document fingerprints: a homomorphic multiset hash of the paragraphs of a text.

Paragraphs are cut at line breaks and, so that long ones do not stand as one block, at white space that follows a
punctuation mark. Each piece is hashed into a wide vector; a document's fingerprint is the sum of its pieces' vectors,
lane by lane, modulo powers of two:

* LANES narrow lanes: one bit of the piece's hash each, summed modulo 2^16;
* SUMS wide lanes: 32 bits of the hash each, summed modulo 2^32;
* the number of pieces, modulo 2^32.

Sums do not depend on the order of pieces, so equal multisets have equal fingerprints, and adding or taking away a piece
is one addition or subtraction (`added`, `removed`). The wide lanes tell different multisets apart (128 bits). The narrow
lanes also estimate how much two have in common (`likeness`).

NULL texts count as empty, their fingerprint is the zero vector; two empty texts are alike (1.0). Repeated rows get equal
results. Everything is a built-in expression: no user functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.llm.common import let, row_key

LANES = 128
SUMS = 4
_LANE, _WIDE = 1 << 16, 1 << 32
_CUT = r"\n|(?<=[^\p{L}\p{N}\s])[\x20\t]+"
MAX_BUCKETS = 1024


def pieces(text: Column) -> Column:
    return F.filter(F.split(text, _CUT), lambda piece: piece != "")


def parts(text: Column) -> Column:
    """The vector of a text: struct(n, lanes, sums)."""

    def bit_sums(hashes: Column) -> Column:
        bit = lambda j: lambda total, h: total + F.call_function("shiftright", h, j).bitwiseAND(F.lit(1))
        zero = F.lit(0).cast("bigint")
        return F.transform(
            F.sequence(F.lit(0), F.lit(63)), lambda j: F.pmod(F.aggregate(hashes, zero, bit(j)), F.lit(_LANE))
        )

    def half_sums(hashes: Column) -> list[Column]:
        zero, mask = F.lit(0).cast("bigint"), F.lit(_WIDE - 1)
        low = F.aggregate(hashes, zero, lambda t, h: (t + h.bitwiseAND(mask)).bitwiseAND(mask))
        high = F.aggregate(hashes, zero, lambda t, h: (t + F.shiftrightunsigned(h, 32)).bitwiseAND(mask))
        return [low, high]

    def vector(given: Column) -> Column:
        first = F.transform(given, lambda p: F.xxhash64(p))
        second = F.transform(given, lambda p: F.xxhash64(p, F.lit("second")))

        def both(a: Column) -> Column:
            def summed(b: Column) -> Column:
                return F.struct(
                    F.size(given).cast("bigint").alias("n"),
                    F.concat(bit_sums(a), bit_sums(b)).alias("lanes"),
                    F.array(*half_sums(a), *half_sums(b)).alias("sums"),
                )

            return let(second, summed)

        return let(first, both)

    return let(pieces(text), vector)


def _joined(a: Column, b: Column, sign: int) -> Column:
    lane = lambda power: lambda x, y: F.pmod(x + y * sign, F.lit(power))
    return F.struct(
        F.pmod(a["n"] + b["n"] * sign, F.lit(_WIDE)).alias("n"),
        F.zip_with(a["lanes"], b["lanes"], lane(_LANE)).alias("lanes"),
        F.zip_with(a["sums"], b["sums"], lane(_WIDE)).alias("sums"),
    )


def added(a: Column, b: Column) -> Column:
    """The vector of both texts' pieces together: incremental insertion."""
    return _joined(a, b, 1)


def removed(a: Column, b: Column) -> Column:
    """The vector of a's pieces without b's: incremental deletion."""
    return _joined(a, b, -1)


def encoded(vector: Column) -> Column:
    """A vector as text: fixed width lower-case hex, count, wide lanes, narrow lanes."""
    digits = lambda x, n: F.lpad(F.lower(F.hex(x)), n, "0")
    return F.concat(
        digits(vector["n"], 8),
        F.array_join(F.transform(vector["sums"], lambda x: digits(x, 8)), ""),
        F.array_join(F.transform(vector["lanes"], lambda x: digits(x, 4)), ""),
    )


def likeness(a: Column, b: Column) -> Column:
    """1 for equal vectors, else the estimated cosine of the two multisets' piece counts, within 0 and 1.

    Twice a narrow lane less the number of pieces is a sum of random signs, one a piece. Products of such sums, averaged
    over the lanes, estimate inner products of the counts. Sums stay far below half the modulus, so it does no harm.
    """
    half = F.lit(_LANE // 2)

    def signs(vector: Column) -> Column:
        return F.transform(vector["lanes"], lambda c: (F.pmod(c * 2 - vector["n"] + half, F.lit(_LANE)) - half).cast("double"))

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda total, product: total + product)

    def cosine(both: Column) -> Column:
        lengths = F.sqrt(dot(both["x"], both["x"]) * dot(both["y"], both["y"]))
        return F.when(lengths > 0, dot(both["x"], both["y"]) / lengths).otherwise(F.lit(0.0))

    equal = (a["n"] == b["n"]) & (a["sums"] == b["sums"]) & (a["lanes"] == b["lanes"])
    near = let(F.struct(signs(a).alias("x"), signs(b).alias("y")), cosine)
    return F.when(equal, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), near)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", encoded(parts(text)).alias("fingerprint"))


def with_next(docs: DataFrame) -> DataFrame:
    """Columns doc_id, _text, _next: each row's text and that of the next row by doc_id (NULL ids first, equal ids by
    their text's hash), after the last row the first.

    Rows are dealt by ranges of doc_id, so the texts are shuffled once and every range is sorted by itself. The first row
    of each range also goes to the range before it, where the last row looks for it. The driver only holds one id per
    range, at most MAX_BUCKETS.
    """
    spark = docs.sparkSession
    ranges = min(MAX_BUCKETS, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("_text"),
        row_key(F.col("text")).alias("_key"),
    )
    shares = [k / ranges for k in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] or []
    edges = F.array(*[F.lit(x).cast("bigint") for x in sorted(set(cuts))]).cast("array<bigint>")
    below = F.size(F.filter(edges, lambda x: x <= F.col("doc_id")))
    dealt = rows.withColumn("_range", F.when(F.col("doc_id").isNull(), 0).otherwise(below))
    name = F.concat_ws("/", F.col("doc_id").cast("string"), F.col("_key").cast("string"))
    heads = (
        dealt.groupBy("_range")
        .agg(F.min_by(name, F.struct("doc_id", "_key")).alias("head"))
        .orderBy("_range")
        .collect()
    )
    before = {heads[k]["head"]: heads[k - 1]["_range"] for k in range(len(heads))}
    first = heads[0]["head"] if heads else None
    pairs = [F.lit(x) for pair in before.items() for x in pair]
    goes = F.create_map(*pairs)[name] if pairs else F.lit(None).cast("int")
    own = F.struct(F.col("_range"), F.lit(False).alias("wraps"), F.lit(True).alias("own"))
    ghost = F.struct(goes.alias("_range"), (name == F.lit(first)).alias("wraps"), F.lit(False).alias("own"))
    places = F.explode(F.when(goes.isNotNull(), F.array(own, ghost)).otherwise(F.array(own))).alias("_place")
    placed = dealt.select("doc_id", "_text", "_key", places).select("doc_id", "_text", "_key", "_place.*")
    return placed.withColumn("_next", F.lead("_text").over(_in_order()))


def _in_order():
    return Window.partitionBy("_range").orderBy("wraps", F.col("doc_id").asc_nulls_first(), "_key", F.col("own").desc())


def edit_report(docs: DataFrame) -> DataFrame:
    """Per row: n_chars, the SHA-256 of its edited text (last half replaced by the start of the next document), both
    fingerprints, and the likeness of its fingerprint to the edited text's and to the next document's."""
    length, half = F.length("_text"), F.floor(F.length("_text") / 2).cast("int")
    following = F.coalesce(F.col("_next"), F.lit(""))
    edited = F.concat(
        F.substring(F.col("_text"), F.lit(1), length - half), F.substring(following, F.lit(1), half)
    )
    placed = with_next(docs).withColumns({"_vector": parts(F.col("_text")), "_edited": edited})
    vectors = placed.withColumns(
        {"_after": F.lead("_vector").over(_in_order()), "_changed": parts(F.col("_edited"))}
    ).where("own")
    return vectors.select(
        "doc_id",
        length.cast("bigint").alias("n_chars"),
        F.sha2(F.col("_edited"), 256).alias("edited_sha256"),
        encoded(F.col("_vector")).alias("fingerprint"),
        encoded(F.col("_changed")).alias("edited_fingerprint"),
        likeness(F.col("_vector"), F.col("_changed")).alias("near_edited"),
        likeness(F.col("_vector"), F.col("_after")).alias("near_next"),
    )
