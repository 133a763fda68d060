"""Plain Python versions of the operators, for small tables."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def repeats(texts, window=35):
    """Per text: number of words, words removed, SHA-256 of the kept ones."""
    split = [words(t) for t in texts]
    seen = collections.Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def shingles(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def components(docs):
    """(doc_id, text) rows: doc_id -> (size of the set, smallest linked doc_id)."""
    sets = [(d, shingles(t)) for d, t in docs]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            both = len(x & y)
            if both and 100 * both >= 80 * len(x | y) and find(a) != find(b):
                high, low = max(find(a), find(b)), min(find(a), find(b))
                root[high] = low
    return {d: (len(s), find(d)) for d, s in sets}


def without_repeats(texts, window=35):
    """The texts with repeated windows cut out; those without any stay as they are."""
    split = [words(t) for t in texts]
    seen = collections.Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for text, w in zip(texts, split, strict=True):
        gone = {i + k for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for k in range(window)}
        out.append(" ".join(x for i, x in enumerate(w) if i not in gone) if gone else text)
    return out


def kept(text, stop_words, rules):
    """The verdict of the base rules and of a table of thresholds."""
    n_words, word_chars, n_symbols, n_dup_lines, _, failed = quality(text)
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    counts = {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": n_symbols,
        "n_dup_lines": n_dup_lines,
        "n_lines": len(lines),
        "n_ellipsis_lines": sum(line.endswith(("...", "…")) for line in lines),
        "n_stop_words": sum(w.strip(".,;:!?\"'()").lower() in stop_words for w in words(text)),
        "n_letter_words": sum(any(c.isalpha() for c in w) for w in words(text)),
    }
    for rule in rules:
        above, below = counts[rule.numerator], counts[rule.denominator]
        if rule.low is not None and above < below * rule.low or rule.high is not None and above > below * rule.high:
            return False
    return not failed


def targets(sizes):
    """source -> target: sizes by source, sources by code point and NULL last weigh 1, 2, 3, none above 3 times its size."""
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[n % 3] for n, s in enumerate(names)}
    full = set()
    while True:
        level = (sum(sizes.values()) - sum(3 * sizes[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        new = {s for s in names if s not in full and level * weight[s] > 3 * sizes[s]}
        if not new:
            return {s: 3 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= new


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    w = words(text)
    grams = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    inside = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(inside), failed)
