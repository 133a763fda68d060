"""Line dedup, hard negatives and alignment against brute-force versions, with the odd rows of each."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowmart.llm import alignment, lines, negatives
from flowmart.llm.queries import QUERIES, tokenizer_path
from tests.conftest import SMALL

PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
WHITE = " \t\n\x0b\x0c\r"
DOCS = "doc_id bigint, text string, `a.b` string, id string, gone string, n_lines string, _given string, n string"


def _clashing(rows):
    return [(k, t, "dot", "i", "g", "l", "w", "n") for k, t in rows]


# --- line dedup


def brute_lines(docs):
    """(doc_id, text) rows without NULL ids -> Counter of (doc_id, n_lines, n_dropped, kept text)."""

    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))

    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc_id)
    out = Counter()
    for doc_id, text in docs:
        given = (text or "").split("\n")
        kept = [x for x in given if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == doc_id]
        out[doc_id, len(given), len(given) - len(kept), "\n".join(kept)] += 1
    return out


def _line_docs():
    pick = random.Random(5)
    pool = [f"Line number {k} of the pool" for k in range(40)] + ["short", "ÄÖÜäöüßéàç", "éééééééé", "", "   ", "kkkkkkkkK", "x" * 3000]
    rows = [(k, "\n".join(pick.choice(pool) + pick.choice(["", " ", "\r", "\t"]) for _ in range(pick.randrange(12)))) for k in range(5, 90)]
    rows += [(1, None), (2, ""), (3, "\n"), (4, "\n".join(["THE same LINE again"] * 3)), (90, " the SAME line again\r"), (91, "\n" * 50)]
    rows += [(92, "every document holds this\nand own 92"), (92, "every document holds this\nand own 92"), (92, "other text of 92\nand own 92")]
    rows += [(k, f"every document holds this\nown line of {k}") for k in range(93, 300)]
    rows += [(300, "very long " * 50_000 + "\nLine number 1 of the pool")]
    return rows


@pytest.mark.parametrize("flush, per_segment, bits", [(1 << 19, 1 << 20, 6), (7, 20, 1)])
def test_lines(spark, monkeypatch, flush, per_segment, bits):
    monkeypatch.setattr(lines, "FLUSH", flush)
    monkeypatch.setattr(lines, "PER_SEGMENT", per_segment)
    monkeypatch.setattr(lines, "_LEAST_BITS", bits)
    given = _line_docs()
    docs = spark.createDataFrame(_clashing(given), DOCS).repartition(5)
    want = Counter()
    for (doc_id, n, gone, kept), times in brute_lines(given).items():
        want[doc_id, n, gone, hashlib.sha256(kept.encode()).hexdigest()] += times
    assert Counter(tuple(r) for r in lines.line_table(docs).collect()) == want


def test_lines_keep_columns_and_null_texts(spark):
    given = [(3, "a line to keep here\nown"), (1, "a line to keep here"), (2, None)]
    docs = spark.createDataFrame(_clashing(given), DOCS)
    got = lines.deduplicated(docs)
    assert got.columns == docs.columns
    assert sorted(tuple(r) for r in got.collect()) == [(k, t, "dot", "i", "g", "l", "w", "n") for k, t in [(1, given[1][1]), (2, None), (3, "own")]]


def test_lines_without_ids(spark):
    """Documents without an id come last; copies of one text are one document."""
    docs = spark.createDataFrame([(7, "shared by an id"), (None, "shared by an id"), (None, "only in copies"), (None, "only in copies")], "doc_id bigint, text string")
    got = sorted((r["doc_id"] or 0, r["n_dropped"]) for r in lines.line_table(docs).collect())
    assert got == [(0, 0), (0, 0), (0, 1), (7, 0)]
    texts = [(None, "in two without ids\nA"), (None, "in two without ids\nB")]
    kept = [r["text"] for r in lines.deduplicated(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()]
    assert sorted(map(len, kept)) == [1, len(texts[0][1])]


def test_filters_lose_no_repeat(spark):
    """Two filters of one segment hold every digest that two packs share, or that is marked."""
    rng = np.random.default_rng(3)
    halves = rng.integers(0, 1 << 63, size=(3000, 2), dtype=np.uint64)
    packs = [halves[:2000], halves[1500:], halves[:10]]
    columns = {name: [] for name in lines._PACKED}
    for pack in packs:
        marks = np.zeros(len(pack), bool)
        marks[-1] = True
        for name, part in zip(lines._PACKED, (pack, np.arange(len(pack)), np.zeros(len(pack), np.int64), marks), strict=True):
            columns[name].append(bytearray(np.ascontiguousarray(part).tobytes()))
    frame = spark.createDataFrame([(0, *x) for x in zip(*(columns[c] for c in lines._PACKED), strict=True)], lines._PACK)
    found = {r["h1"] for r in lines._suspects(frame).collect()}
    times = Counter(int(x) for pack in packs for x in pack[:, 0])
    again = {k for k, n in times.items() if n > 1} | {int(pack[-1, 0]) for pack in packs}
    assert again <= found
    assert len(found - again) < 60


# --- hard negatives


def brute_negatives(rows, every=50):
    """(vec_id, vector, label) rows with different ids."""
    sound = [(k, [int(np.floor(256 * float(x))) for x in v], y) for k, v, y in rows
             if v is not None and y is not None and all(x is not None and np.isfinite(x) for x in v)]

    def score(v, w):
        return sum(x * y for x, y in zip(v, w, strict=False))

    last = lambda k: (k is None, k)
    out = []
    for anchor, v, y in sound:
        if anchor is None or anchor % every:
            continue
        ranked = sorted(((-score(v, w), last(k), k, z) for k, w, z in sound if k != anchor), key=lambda r: r[:2])
        for minus, _, positive, _ in [r for r in ranked if r[3] == y][:5]:
            p = -minus
            band = [r for r in ranked if r[3] != y and 50 * p <= -100 * r[0] <= 95 * p][:3]
            out += [(anchor, positive, k + 1, r[2], p, -r[0]) for k, r in enumerate(band)]
    return sorted(out, key=repr)


def _vectors(n=700, d=19, seed=2):
    rng = np.random.default_rng(seed)
    base = rng.normal(0, 0.4, size=(n, d))
    base[100:300] = base[100]  # a third are copies of one vector
    rows = [(k, [float(x) for x in base[k]], int(rng.integers(0, 4)) if k % 3 else 0) for k in range(n)]
    rows[10] = (10, None, 1)
    rows[11] = (11, [None] * d, 1)
    rows[12] = (12, [float("nan")] * d, 1)
    rows[13] = (13, [float("inf")] + [0.0] * (d - 1), 1)
    rows[14] = (14, rows[14][1], None)
    rows[15] = (15, [], 1)
    rows[16] = (16, rows[16][1][:5], 2)
    rows[17] = (None, rows[100][1], 2)
    rows[18] = (18, [300.0, -300.0] + [0.5] * (d - 2), 3)
    return rows


@pytest.mark.parametrize("block, chunk, side", [(1 << 13, 1 << 11, 128), (90, 32, 3)])
def test_negatives(spark, monkeypatch, block, chunk, side):
    for name, value in (("ROWS", block), ("ANCHORS", block // 10), ("_CHUNK", chunk), ("_SIDE", side)):
        monkeypatch.setattr(negatives, name, value)
    rows = _vectors()
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows + rows[:60]], "vec_id bigint, vector array<double>, label int, anchor string, q string")
    got = negatives.mined(frame, F.col("vec_id") % 50 == 0)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_negatives(rows)
    assert [t for _, t in got.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]


def test_scores_by_tables():
    rng = np.random.default_rng(1)
    for high in (3, 200, 1 << 20):
        x, a = (rng.integers(-high, high, size=(n, 24)).astype(np.int32) for n in (50, 9))
        assert (negatives.scores(negatives.planes(x), a) == a.astype(np.int64) @ x.T.astype(np.int64)).all()
    assert (negatives.scores(negatives.planes(np.zeros((4, 8), np.int32)), np.ones((2, 8), np.int32)) == 0).all()


def test_negatives_without_rows_or_anchors(spark):
    schema = "vec_id bigint, vector array<float>, label int"
    for rows in ([], [(1, [0.5], 1), (2, [0.25], 0)]):
        assert negatives.mined(spark.createDataFrame(rows, schema), F.col("vec_id") % 50 == 0).collect() == []


def test_negatives_query(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"] if r["vec_id"] % 7 else (r["label"] + 1) % 10)
            for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = QUERIES["op12_hard_negatives"](spark, SMALL).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_negatives(rows)
    assert got


# --- alignment


def _spell():
    itself = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in itself}
    letters |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in itself)}
    return letters


def brute_alignment(docs):
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    letters = _spell()

    def spans(tokens):
        out, at = [], 0
        for k, token in tokens:
            out.append((k, at, at + len(token)))
            at += len(token)
        return out

    found = []
    for _, text in docs:
        whole = (" " + (text or "")).encode()
        code = a.encode(whole.decode(), add_special_tokens=False)
        ta = [(k, bytes(letters[c] for c in t)) for k, t in zip(code.ids, code.tokens, strict=True)]
        tb = [(k, bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode())
              for k, p in ((k, b.id_to_piece(k)) for k in b.encode(text or ""))]
        if not text or not b"".join(t for _, t in ta) == b"".join(t for _, t in tb) == whole:
            found.append(None)
            continue
        sa, sb = spans(ta), spans(tb)
        cuts = sorted({e for *_, e in sa} & {e for *_, e in sb})
        groups, start = [], 0
        for cut in cuts:
            part = lambda s: ",".join(str(k) for k, x, e in s if start <= x and e <= cut)  # noqa: E731, B023
            groups.append(f"{part(sa)}|{part(sb)}")
            start = cut
        links = [(ka, kb) for ka, xa, ea in sa for kb, xb, eb in sb if xa < eb and xb < ea]
        found.append((len(sa), len(sb), groups, links))
    counts = Counter(link for f in found if f for link in f[3])
    highest = Counter()
    for (_, kb), n in counts.items():
        highest[kb] = max(highest[kb], n)
    out = []
    for (doc_id, _), f in zip(docs, found, strict=True):
        if f is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        best = sum(counts[x] == highest[x[1]] for x in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((doc_id, n_a, n_b, len(groups), len(links), best, sum(counts[x] for x in links), digest))
    return sorted(out, key=repr)


def _aligned_docs():
    odd = [None, "", " ", "\n", "  two  spaces ", "a\nb\n\nc", "tab\there", "it's <|endoftext|> <s> </s> <0x41> <unk>", "ﬁ ① é é", "low ▁ line",
           "日本語 の テキスト", "😀😀 x", "a\x00b", " nbsp  em", "x" * 3000, " lead", "trail ", "a \n b", "\x1c\x1d y", "'s 're", "12345 6.78"]
    pick = random.Random(4)
    words = ["the", "reading", "of", "Straße", "naïve", "unhappily", "co-operate", "été", "9999", "…", "(see", "x);", "\n"]
    rows = list(enumerate(odd)) + [(100 + k, " ".join(pick.choice(words) for _ in range(pick.randrange(80)))) for k in range(40)]
    return rows + [rows[5], rows[-1], (None, "the reading"), (500, "word " * 20_000 + "end")]


@pytest.mark.parametrize("limits", [{}, {"SHARDS": 5, "SLICE": 40, "FAN": 2, "_DOCUMENTS": 3, "_HELD": 90}])
def test_alignment(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(alignment, name, value)
    rows = _aligned_docs()[: -1 if limits else None]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id bigint, text string, shard string, key string").repartition(3)
    if not limits:  # pieces of a word of many repeats would take the brute-force version minutes
        rows = rows[:-1]
        docs = docs.where("doc_id IS NULL OR doc_id < 500")
    got = alignment.aligned_documents(docs, *PATHS).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_alignment(rows)


def test_alignment_of_a_long_text_and_of_nothing(spark):
    schema = "doc_id bigint, text string"
    assert alignment.aligned_documents(spark.createDataFrame([], schema), *PATHS).collect() == []
    nothing = alignment.aligned_documents(spark.createDataFrame([(1, None), (2, "")], schema), *PATHS).collect()
    assert sorted(tuple(r) for r in nothing) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    long = alignment.aligned_documents(spark.createDataFrame([(3, "word " * 100_000 + "word")], schema), *PATHS).first()
    assert long["n_links"] == 100_001 and long["count_sum"] == 100_001**2


def test_units_cut_like_the_whole():
    tokenizers = alignment.Tokenizers.at(*PATHS)
    for _, text in _aligned_docs():
        if text:
            whole_a, whole_b = tokenizers.encoded([" " + text])
            parts_a, parts_b = tokenizers.encoded(alignment.units(text))
            assert [k for x in parts_a for k in x] == whole_a[0]
            assert [k for x in parts_b for k in x] == whole_b[0]


def test_batches_are_split_like_single_texts():
    texts = [text for _, text in _aligned_docs()] + ["a\u3000 b", "a\u2028 b", "x\x1c y", "z\n", "q\x85 r", "plain text", " \t"]
    for given in (texts, texts[::-1]):
        words, counts = zip(*alignment._split(pa.array(given, pa.string())), strict=True)
        flat = pa.concat_arrays(words).to_pylist()
        want = [[unit[1:] for unit in alignment.units(text)] if text else [] for text in given]
        assert np.concatenate(counts).tolist() == [len(own) for own in want]
        assert flat == [word for own in want for word in own]


def test_ranks_give_the_ids_of_the_file(spark):
    tokenizers = alignment.Tokenizers.at(*PATHS)
    assert tokenizers._ranked is not None
    texts = [f" {r['text']}" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect() if r["text"]]
    texts += [" " + text for _, text in _aligned_docs() if text]
    texts = [text for text in texts if len(text) <= alignment._RANKED]
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    assert tokenizers.encoded(texts)[0] == [code.ids for code in a.encode_batch(texts, add_special_tokens=False)]


def test_many_units_at_once_align_like_each_alone(monkeypatch):
    tokenizers = alignment.Tokenizers.at(*PATHS)
    texts = list(dict.fromkeys(unit for _, text in _aligned_docs() if text for unit in alignment.units(text)))
    together = alignment.aligned(texts, tokenizers, named=True)
    monkeypatch.setattr(alignment, "_TOGETHER", 1)
    alone = alignment.aligned(texts, tokenizers, named=True)
    assert not alone.sound.all() and together.groups == alone.groups
    for name in ("sound", "n_a", "n_b", "n_groups", "n_links", "pairs"):
        assert (getattr(together, name) == getattr(alone, name)).all()


def test_numbering_is_minimal_and_perfect():
    keys = np.unique(np.random.default_rng(2).integers(0, 1 << 50, 20_000))
    numbering = alignment.Numbering.of(keys)
    assert sorted(numbering.numbers(keys).tolist()) == list(range(len(keys)))
    again = alignment.Numbering.unpacked(numbering.packed())
    assert (again.numbers(keys) == numbering.numbers(keys)).all()
    assert len(alignment.Numbering.of(keys[:0]).levels) == 0


def test_look_up_verifies_keys():
    keys = np.array([5, 1029, 77], np.int64)
    numbering = alignment.Numbering.of(keys[:2])
    placed = np.empty(2, np.int64)
    placed[numbering.numbers(keys[:2])] = keys[:2]
    table = alignment.Counts([(5, numbering.packed(), placed.tobytes(), np.array([3, 4]).tobytes(), np.array([True, False]).tobytes())])
    counts, _ = table.of(keys)
    assert sorted(counts.tolist()) == [0, 3, 4]  # shard 77 is not in this round
    with pytest.raises(ValueError, match="not counted"):
        table.of(np.array([5 + 1024 * 9], np.int64))


def test_blocks_hold_equal_rows_once(spark):
    rows = [(k % 5, 1, bytearray(b"\0\0\0\0")) for k in range(50)]
    frame = spark.createDataFrame(rows, "vec_id bigint, label bigint, q binary")
    held = negatives._blocks(frame, "cblock", 1).collect()
    assert [r["n"] for r in held] == [5]
    assert isinstance(pa.array([1]), pa.Array)
