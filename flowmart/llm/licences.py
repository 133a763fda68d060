"""Licence scans: canonical digests of entire texts, hash-joined to the digests of known licences.

Canonical form: lines that state a copyright go, case, punctuation and white space are levelled, equivalent spellings
become one. The SHA-256 of what is left identifies the text. The unit is an entire text: the whole document, and beside
it each of its lines (a notice is a text of one line). NULL texts count as empty; an empty canonical form matches
nothing. Repeated rows get the same result each, an empty table gives an empty one, extra columns are not read.

The known licences are those of the folder licence_texts, beside the few of KNOWN: a file of the entire text each, and
names.txt with the names by which one-line notices call them (SPDX id | name | name ...).
"""

from __future__ import annotations

import re
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.llm.common import let

# Spellings that licence matching treats as equal (left becomes right).
SPELLINGS = (
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("organisation", "organization"),
    ("organisations", "organizations"),
    ("authorised", "authorized"),
    ("favour", "favor"),
    ("fulfilment", "fulfillment"),
    ("judgement", "judgment"),
    ("merchantibility", "merchantability"),
    ("acknowledgement", "acknowledgment"),
    ("per cent", "percent"),
    ("version 2 0", "v2"),
    ("version 2", "v2"),
    ("version 3", "v3"),
)
COPYRIGHT_LINE = r"^[^\p{L}\p{N}©]*(copyright|©|\(c\) |all rights reserved)"

# Texts of widely used licences and their customary one-line notices.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
# The list that the SQL of the query states.
KNOWN = (
    ("MIT", "MIT License\n" + MIT),
    ("MIT", MIT),
    ("ISC", "ISC License\n" + ISC),
    ("ISC", ISC),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)
# What customary notices say around the name of a licence.
NOTICES = (
    *[f"{verb} under {of}{{}}" for verb in ("Licensed", "Released", "Distributed") for of in ("", "the ", "the terms of the ")],
    *[f"{verb} under {the}{{}}" for verb in ("Available", "Published") for the in ("", "the ")],
    *[f"Licensed under {a} {{}}" for a in ("a", "an")],
    *[
        f"This {work} is {verb} {{}}"
        for work in ("work", "project", "software", "program", "content")
        for verb in ("licensed under", "licensed under the", "licensed under a", "released under the")
    ],
    "SPDX-License-Identifier: {}",
    "License: {}",
)
_TEXTS = Path(__file__).resolve().parent / "licence_texts"
_BUCKETS = 4096  # as many as three hexadecimal digits tell apart


def _copies(text: str, names: list[str]) -> set[str]:
    """The forms in which an entire text goes around: with and without its name above, its appendix and the sections
    around it, under either address of a site, in lines of any length, with or without numbers of a list."""
    forms = {text, re.sub(r"(?m)^( *)\d\. ", r"\1* ", text)} if len(text) < 2000 else {text}
    forms |= {f.replace("HOLDERS AND CONTRIBUTORS", "OWNERS AND CONTRIBUTORS") for f in forms}
    end = "END OF TERMS AND CONDITIONS"
    forms |= {f.split(end)[0] + tail for f in forms if end in f for tail in ("", end)}
    sections = re.split(r"(?m)^=====+$", text)
    forms |= {"\n".join(sections[:2]), sections[1]} if len(sections) == 3 else set()
    forms |= {f.replace(a, b) for f in forms for a, b in (("http://", "https://"), ("https://", "http://"))}
    forms |= {re.sub(r"(?<!\n)\n(?!\n)", " ", f) for f in forms}
    if len(text) < 2000:
        forms |= {f"{title}{name}\n\n{f}" for f in forms for name in names for title in ("", "The ")}
    return forms


@cache
def common_licences() -> tuple[tuple[str, str], ...]:
    """(licence, text) of all known licences: KNOWN, entire texts in all their forms, and notices."""
    names = {}
    for line in (_TEXTS / "names.txt").read_text(encoding="utf-8").splitlines():
        licence, *called = line.split("|")
        names[licence] = called
    texts = {path.stem: path.read_text(encoding="utf-8") for path in sorted(_TEXTS.glob("*.txt")) if path.name != "names.txt"}
    texts |= {"MIT": MIT, "ISC": ISC}
    entire = {(licence, form) for licence, text in texts.items() for form in _copies(text, names[licence])}
    notices = {(licence, notice.format(name)) for licence, called in names.items() for name in called for notice in NOTICES}
    return (*KNOWN, *sorted(entire | notices))


def canonical(text: Column) -> Column:
    """The canonical form of an entire text."""
    lines = F.filter(F.split(F.lower(text), "\n"), lambda line: ~line.rlike(COPYRIGHT_LINE))
    level = F.concat(F.lit(" "), F.regexp_replace(F.array_join(lines, " "), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    variants = "|".join(variant for variant, _ in SPELLINGS)

    def spelled(form: Column) -> Column:
        usual = form
        for variant, word in SPELLINGS:
            usual = F.replace(usual, F.lit(f" {variant} "), F.lit(f" {word} "))
        return F.when(form.rlike(f" ({variants}) "), usual).otherwise(form)

    return F.btrim(F.regexp_replace(let(level, spelled), " +", " "))


def digest(form: Column) -> Column:
    """Digest of a canonical form; NULL for an empty one, which then joins with nothing."""
    return F.when(form != "", F.sha2(form, 256))


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] | None = None) -> DataFrame:
    """(digest, licence): one row per digest; of licences with the same digest the first name by code point stays.
    Without `known` all listed licences."""
    texts = spark.createDataFrame(list(common_licences() if known is None else known), "licence string, text string")
    listed = texts.select("licence", digest(canonical(F.col("text"))).alias("digest"))
    return listed.where("digest IS NOT NULL").groupBy("digest").agg(F.min("licence").alias("licence"))


def licence_scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, digest of the whole text, licence it equals (or NULL), notices: the sorted
    licences that entire lines of the text equal.

    `known` (digest, licence) is the list of licences, broadcast: its size is that of the list, not of the corpus.
    Notices are looked up within the row, so no row is multiplied and nothing is shuffled. A map is searched from its
    start, so the list is one small map for each beginning of a digest.
    """
    bucket = lambda found: F.conv(F.substring(found, 1, 3), 16, 10).cast("int")
    listed = F.broadcast(known.select(F.col("digest").alias("_digest"), "licence"))
    pair = F.map_from_entries(F.collect_list(F.struct("digest", "licence")))
    maps = known.groupBy(bucket(F.col("digest")).alias("bucket")).agg(pair.alias("pairs"))
    by_bucket = F.map_from_entries(F.collect_list(F.struct("bucket", "pairs")))
    lookup = maps.agg(F.transform(F.sequence(F.lit(0), F.lit(_BUCKETS - 1)), lambda k: by_bucket[k])).scalar()
    text = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    whole = text.select("doc_id", "_text", digest(canonical(F.col("_text"))).alias("digest"))
    named = whole.join(listed, F.col("digest") == F.col("_digest"), "left").withColumn("_lookup", lookup)
    name = lambda line: let(digest(canonical(line)), lambda d: F.get(F.col("_lookup"), bucket(d))[d])
    found = F.transform(F.split("_text", "\n"), name)
    notices = F.array_sort(F.array_distinct(F.filter(found, lambda name: name.isNotNull())))
    return named.select("doc_id", "digest", "licence", notices.alias("notices"))
