"""Probes of common markup, a plain version of the two passes, and models against plain versions."""

import math
import random
import time

import numpy as np
import pytest

from flowmart.llm import grading, languages, pages
from tests.conftest import rows

TEXT = "The old man and the sea is a story of the long fight of a man with a fish, and it was written for all of us in the year that he won. " * 4
TEXT = TEXT.strip()
NOTE = "A short note on the one that got away."


@pytest.mark.parametrize("before", [
    '<div class="post-comments-open">', '<div id="share-your-story">', '<div class="notice">', '<div id="content" class="side social">',
    '<div class="widget"><div class="promo">',
])
def test_a_hint_does_not_empty_a_page(before):
    assert pages.main_text(f"<body>{before}<p>{TEXT}</p></body>") == TEXT


def test_a_hint_still_counts_beside_a_text():
    for name in ("comments", "sidebar", "cookie-notice", "related"):
        assert pages.main_text(f'<div><p>{TEXT}</p></div><div class="{name}"><p>{TEXT} again</p></div>') == TEXT
    # Short notices alone are no text of a page.
    assert pages.main_text('<div class="cookie-notice"><p>We use cookies and all of the other things that are on this page to be of use.</p></div>') == ""


def test_cards_inside_links_are_links():
    card = "Another of the cards that is in it and was for all of the men, with more of the same in it and to it."
    for inner in (f"<h3>A card</h3><p>{card}</p>", f"<div>{card}</div>", f"<div><div>{card}</div><p>{card}</p></div>"):
        assert pages.main_text(f"<div><p>{TEXT}</p></div><a href='x'>{inner}</a>") == TEXT
    # A link without an end covers its own block only.
    assert pages.main_text(f"<p><a name='top'>Start</p><p>{TEXT}</p>") == TEXT


def test_hidden_by_style():
    for style in ("display:none", "color: red; display : none", "VISIBILITY: hidden"):
        assert pages.main_text(f'<p>{TEXT}</p><div style="{style}"><p>{TEXT} more</p></div>') == TEXT
    assert pages.main_text(f'<div style="overflow:hidden; display:block"><p>{TEXT}</p></div>') == TEXT


def test_a_page_of_one_short_paragraph():
    assert pages.main_text("<html><body><p>Zebra crossing painted yesterday.</p></body></html>") == "Zebra crossing painted yesterday."
    assert pages.main_text('<nav><p>Home</p></nav><p><a href="x">All news</a></p>') == ""


@pytest.mark.parametrize("page", [
    "<div>" * 50_000 + "</section>" * 50_000, "<article>" * 30_000 + "x" + "</aside>" * 30_000, "<a href=x>" * 50_000 + "<p>" * 50_000,
    "<p>" + "word " * 400_000,
])
def test_long_and_mismatched_pages_take_no_long_time(page):
    started = time.process_time()
    pages.main_text(page)
    assert time.process_time() - started < 6


def _plain(found, sides):
    """The two passes block by block, every neighbour looked for anew."""
    marked = any(b.article and b.side < sides for b in found)
    if not marked:
        pages._mark_foreign(found, sides)
    first = [pages._first_pass(b, marked, sides) for b in found]
    out = []
    for k, block in enumerate(found):
        label = first[k]
        if label is None:
            decided = [j for j in range(len(found)) if first[j] is not None and (not marked or found[j].article and found[j].side < sides)]
            before, after = [j for j in decided if j < k], [j for j in decided if j > k]
            near = [first[before[-1]]] if before else []
            near += [first[after[0]]] if after else []
            if block.heading and after:
                near = [first[after[0]]]
            own = block.foreign and len(block.text) >= pages.SHORT
            if not near:
                label = marked or pages._stop_density(block.text) >= pages.STOP_LOW or own
            elif all(x == near[0] for x in near):
                label = near[0]
            else:
                label = marked or pages._stop_density(block.text) >= pages.STOP_HIGH or own
        if label:
            out.append(block.text)
    return out


def test_two_passes_against_a_plain_version():
    pick = random.Random(8)
    inner = [f"<p>{TEXT}</p>", f"<p>{NOTE}</p>", "<h2>Heading</h2>", "<p>Buy now!</p>", '<p><a href="x">Read all of it</a></p>', "<p>© 2020 of the firm</p>",
             f"<div>{NOTE * 3}</div>", "<li>one</li>", "<p>Утром старый рыбак вышел к реке и долго смотрел на воду, потому что за ночь она поднялась почти до моста.</p>"]
    outer = ["<div>%s</div>", "<article>%s</article>", "<nav>%s</nav>", '<div class="comments">%s</div>', "%s", '<div class="widget">%s</div>']
    for _ in range(300):
        page = "".join(pick.choice(outer) % "".join(pick.choice(inner) for _ in range(pick.randrange(4))) for _ in range(pick.randrange(6)))
        found = pages.blocks(page)
        for sides in (1, 2, 3):
            assert [b.text for b in pages._second_pass(found, sides)] == _plain(found, sides)


def test_pages_edge_rows(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars string, `a.b` string"
    given = [(1, "u", None, "t", "n", "d"), (2, None, "", "t", "n", "d"), (None, "u", f"<p>{TEXT}", "t", "n", "d"), (None, "u", f"<p>{TEXT}", "t", "n", "d")]
    got = rows(pages.extracted(spark.createDataFrame(given, schema)))
    assert got == sorted([(1, "u", "", 0), (2, None, "", 0), *[(None, "u", TEXT, len(TEXT))] * 2], key=repr)
    assert pages.extracted(spark.createDataFrame([], schema)).collect() == []


# --- models


def test_grading_with_clashing_columns_and_empty_tables(spark):
    schema = "doc_id bigint, text string, grade int, places string, `a.b` string"
    given = [(k, f"word{k % 7} good text {k}" if k % 2 else f"bad junk {k % 5}", 9, "p", "d") for k in range(60)] + [(None, None, 1, "p", "d"), (7, "", 1, "p", "d")]
    docs = spark.createDataFrame(given, schema)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)], "doc_id bigint, quality int, toxic int")
    model = grading.trained(docs, grading.ratings(labels), sample=30)
    again = grading.trained(docs.repartition(3), grading.ratings(labels), sample=30)
    assert (model.weights == again.weights).all()
    graded = {r["doc_id"]: r["expected_grade"] for r in grading.graded(docs, model).where("doc_id >= 40").collect()}
    assert min(graded[k] for k in range(41, 60, 2)) > max(graded[k] for k in range(40, 60, 2))
    none = docs.limit(0)
    empty = grading.trained(none, grading.ratings(labels))
    assert grading.graded(none, empty).collect() == [] and (empty.weights == 0).all()


def test_the_fit_is_close_to_the_maximum_of_the_penalised_likelihood():
    """Against a plain likelihood: a small step of a weight or threshold makes it larger by a thousandth at most."""
    rng = np.random.default_rng(3)
    texts = [(" ".join(f"w{x}" for x in rng.integers(0, 12, 9)) + (" fine" if k % 3 == 0 else " poor")).encode() for k in range(90)]
    places, counts = grading.features(texts)
    grades = np.array([2 if k % 3 == 0 else int(rng.integers(0, 2)) for k in range(90)])
    model = grading.fitted(places, counts, grades)

    def loss(weights, thresholds):
        total = 0.0
        for k, own in enumerate(np.split(places, np.cumsum(counts)[:-1])):
            place = sum(float(weights[j]) for j in own)
            above = [1.0, *[1 / (1 + math.exp(t - place)) for t in thresholds], 0.0]
            total -= math.log(max(1e-9, above[grades[k]] - above[grades[k] + 1]))
        return total / len(grades) + grading.PENALTY / 2 * float((weights**2).sum())

    weights, thresholds = model.weights.astype(float), model.thresholds
    best = loss(weights, thresholds)
    held = np.flatnonzero(weights)
    for j in held[:: max(1, len(held) // 25)]:
        for step in (-0.05, 0.05):
            moved = weights.copy()
            moved[j] += step
            assert loss(moved, thresholds) > best - 1e-3
    for j in range(len(thresholds)):
        for step in (-0.05, 0.05):
            moved = thresholds.copy()
            moved[j] += step
            assert loss(weights, moved) > best - 1e-3


def test_languages_with_clashing_columns_and_empty_tables(spark):
    schema = "doc_id bigint, text string, lang string, source string, lang_pred string, score string, `a.b` string"
    given = [(k, "the cat and the dog " * 4 if k % 2 else "der hund und die katze " * 4, "en" if k % 2 else "de", "s", "l", "x", "d") for k in range(40)]
    given += [(100, None, "en", "s", "l", "x", "d"), (101, "", None, "s", "l", "x", "d"), (102, "12 34", "en", "s", "l", "x", "d"), (None, "the cat", "en", "s", "l", "x", "d")]
    docs = spark.createDataFrame(given, schema)
    got = {r["doc_id"]: r for r in languages.language_table(docs).collect()}
    assert all(got[k]["lang_pred"] == ("en" if k % 2 else "de") for k in range(40))
    assert {got[k]["lang_pred"] for k in (100, 101, 102)} == {"und"}
    assert languages.language_table(docs.limit(0)).collect() == []


def test_many_languages_take_bounded_memory(spark, monkeypatch):
    """Sums sent in small lots give the same prototypes as sums held to the end."""
    given = [(f"{chr(97 + k % 23) * 3} word{k % 23} text of {k % 23} " * 3, f"l{k % 23}") for k in range(92)]
    docs = spark.createDataFrame(given, "text string, lang string").coalesce(2)
    whole = languages.prototypes(docs)
    monkeypatch.setattr(languages, "_HELD_LANGUAGES", 2)
    lots = languages.prototypes(docs)
    assert [name for name, _ in lots] == [name for name, _ in whole] and len(lots) == 23
    assert all(np.allclose(x, y, atol=1e-6) for (_, x), (_, y) in zip(whole, lots, strict=True))
