"""Quality rules: a table of thresholds that is compiled into one Spark projection, without user functions.

Each rule bounds a ratio of counts that the projection takes from the whole text. NULL and empty texts have no words
and fail the base rule; repeated rows are judged alike; an empty table gives an empty result. Columns of the input other
than those asked for are never read, so extra columns cannot clash.

The rule of stop words asks for those of four languages, so it rejects only where one of them may be meant: not a text that
is mostly in another script, has letters of other alphabets, or has function words of other languages.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmart.llm.common import WHITE, let, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Frequent function words of the languages of the corpus.
STOP_WORDS = (
    "the of and to in is that for it as was with be by on are this from at or an not have he his but they which "
    "de la le et les des en un du une que est pour qui dans par au sur pas avec il ce ne se plus son "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an aus er "
    "el y los del las una con no su para al lo como más pero sus o este sí porque"
).split()
# Frequent function words of other languages in Latin script, two letters at least.
OTHER_STOP_WORDS = (
    "di che il per non della sono gli alla dei nel anche delle questo ma come ha si "  # Italian
    "não uma os em do da dos das mais foi ao pelo são também seu sua ou "  # Portuguese, Galician
    "het een van dat op te niet zijn met voor er maar om ook aan bij naar dit wordt wat "  # Dutch, Afrikaans
    "och att som på är av för det inte jag han till har ett men om vi kan från den de "  # Swedish
    "og er til af ikke jeg på med det som at vi kan skal var ved fra eller et hun "  # Danish, Norwegian
    "ja on ei että oli hän se mutta kuin niin myös ovat joka kun tai olla "  # Finnish
    "ning see oma kui ka siis aga mis "  # Estonian
    "nie się na jest że do jak ale po tak jego przez od być czy tym który dla oraz "  # Polish
    "je na se že to jako by ale si za nebo pro jsou který jeho které byl ve po aby ako som sa pre sú "  # Czech, Slovak
    "je da na su se za od ne kao koji bio ili ali što iz bi pri tudi ki so "  # Croatian, Bosnian, Serbian, Slovene
    "és hogy nem is az egy ez meg volt csak van mint de már ki még vagy "  # Hungarian
    "și să nu în cu pe din este care mai sunt ce sau fost au dar "  # Romanian
    "ve bir bu da ne için ile de çok gibi daha ama olarak olan kadar ise "  # Turkish, Azeri
    "yang dan di itu dengan untuk tidak ini dari dalam akan pada juga saya ke oleh adalah ada "  # Indonesian, Malay
    "là và của có không một được cho các người này trong những với "  # Vietnamese
    "els amb per és dels del va com més són "  # Catalan
    "ir kad tai yra su kaip bet iš buvo un ka ar par bija no uz kas "  # Lithuanian, Latvian
    "na ya wa kwa ni za katika la kuwa cha hii "  # Swahili
    "ang ng sa mga na ay hindi ito siya kung "  # Tagalog
    "yn mae ar ac wedi bod gan am yr agus an na ar ag bhí sé go "  # Welsh, Irish
    "dhe të në që një për me nuk është eta da ez bat ere dira zen "  # Albanian, Basque
    "et non ad cum sed est ut quod qui ex kaj la estas ne al por "  # Latin, Esperanto
).split()
# The letters of Latin script, and those of them that English, French, German and Spanish write with.
LATIN = "A-Za-zªºÀ-ÖØ-öø-ʯḀ-ỿⱠ-Ɀ꜠-ꟿﬀ-ﬆＡ-Ｚａ-ｚ"
OWN_LATIN = "A-Za-zªºÀÁÂÄÆÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜàáâäæçèéêëíîïñóôöùúûüÿßœŒŸẞﬀ-ﬆ"
OTHER_LETTERS = 0.01
STOP_WORD_RATIO = "stop_word_ratio"
DUP_LINE_RATIO = "dup_line_ratio"
DUP_CHARACTERS = 0.2  # share of the characters of all lines that duplicate lines hold


@dataclass(frozen=True)
class Rule:
    """A text passes when low <= numerator / denominator <= high; an open side is None."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbol_ratio", "n_symbols", "n_words", high=0.1),
    Rule(STOP_WORD_RATIO, "n_stop_words", "n_words", low=0.04),
    Rule("letter_word_ratio", "n_letter_words", "n_words", low=0.7),
    Rule(DUP_LINE_RATIO, "n_dup_lines", "n_lines", high=0.3),
    Rule("ellipsis_line_ratio", "n_ellipsis_lines", "n_lines", high=0.3),
)


def _covered(starts: Column) -> Column:
    """Number of positions covered by three-word windows at the given ascending starts."""
    steps = F.transform(starts, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - p, F.lit(3))))
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, step: total + step)


def _repeated(pairs: Column) -> Column:
    """Ascending places of those (value, place) pairs whose value occurs more than once."""

    def pick(ordered: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(ordered, k)["value"] == x["value"], F.lit(False))
        kept = F.filter(ordered, lambda x, k: same(x, k + 1) | F.when(k > 0, same(x, k - 1)).otherwise(False))
        return F.sort_array(F.transform(kept, lambda x: x["place"]))

    return let(F.sort_array(pairs), pick)


def repeat_words(tokens: Column) -> Column:
    """Words inside three-word windows that occur at least twice in the text, the first occurrence included.

    Equal hashes choose the candidate windows; only those few are compared as text, so the count is exact.
    """

    def count(w: Column) -> Column:
        last = F.size(w) - 3
        gram = lambda i: [F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)]
        pair = lambda value, i: F.struct(value.alias("value"), i.alias("place"))
        hashed = F.transform(F.sequence(F.lit(0), last), lambda i: pair(F.xxhash64(*gram(i)), i))
        exact = lambda places: F.transform(places, lambda i: pair(F.concat_ws(" ", *gram(i)), i))
        found = let(let(_repeated(hashed), lambda places: _repeated(exact(places))), _covered)
        return F.when(last >= 1, found).otherwise(F.lit(0).cast("bigint"))

    return let(tokens, count)


def _removed(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _other_language(text: Column, tokens: Column, low: float) -> Column:
    """Whether a text with few stop words is likely to be in a language that STOP_WORDS does not hold."""
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    latin = count(f"[{LATIN}]")
    script = count(r"\p{L}") > 2 * latin
    alphabet = count(f"[{LATIN}&&[^{OWN_LATIN}]]") > latin * F.lit(OTHER_LETTERS)
    known = F.filter(tokens, lambda w: _bare(w).isin([*STOP_WORDS, *OTHER_STOP_WORDS]))
    return script | alphabet | (F.size(known) >= F.size(tokens) * F.lit(low))


def _bare(word: Column) -> Column:
    return F.lower(F.btrim(word, F.lit(".,;:!?\"'()")))


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: _removed(line, WHITE) != "")


def _size(array: Column) -> Column:
    return F.size(array).cast("bigint")


def _characters(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0).cast("bigint"), lambda n, line: n + F.length(line))


def _counts(text: Column, tokens: Column, lines: Column) -> Column:
    counts = {
        "n_words": _size(tokens),
        "word_chars": F.length(_removed(text, WHITE)).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(_removed(text, SYMBOLS))).cast("bigint"),
        "n_lines": _size(lines),
        "n_dup_lines": _size(lines) - _size(F.array_distinct(lines)),
        "n_ellipsis_lines": _size(F.filter(lines, lambda line: line.endswith("...") | line.endswith("…"))),
        "n_repeat_words": repeat_words(tokens),
        "n_stop_words": _size(F.filter(tokens, lambda w: _bare(w).isin(STOP_WORDS))),
        "n_letter_words": _size(F.filter(tokens, lambda w: w.rlike(r"\p{L}"))),
    }
    return F.struct(*[count.alias(name) for name, count in counts.items()])


def _passes(rule: Rule, counts: Column, text: Column, tokens: Column, lines: Column) -> Column:
    """Compares products, not quotients, so that nothing is divided and thresholds are met exactly. Two rules have an
    exception, which is looked at in the few texts that break them: few stop words in a text that is likely to be in another
    language, and duplicate lines that hold a small share of the characters of all lines."""
    above, below = counts[rule.numerator].cast("double"), counts[rule.denominator].cast("double")
    low = F.lit(True) if rule.low is None else above >= below * F.lit(rule.low)
    high = F.lit(True) if rule.high is None else above <= below * F.lit(rule.high)
    if rule.name == STOP_WORD_RATIO:
        return F.when(low, high).otherwise(high & _other_language(text, tokens, rule.low))
    if rule.name == DUP_LINE_RATIO:
        all_, different = _characters(lines), _characters(F.array_distinct(lines))
        return F.when(high, low).otherwise(low & (all_ - different <= all_ * F.lit(DUP_CHARACTERS)))
    return low & high


def _verdict(text: Column, rules: tuple[Rule, ...]) -> Column:
    """All counts, base_failed, failed_rules (names, in order of the table) and kept, as one struct.

    Words, lines and counts are bound one in another, so each is made once, also where a filter asks for `kept` alone.
    """

    def ruled(counts: Column, tokens: Column, lines: Column) -> Column:
        checks = [F.when(~_passes(rule, counts, text, tokens, lines), F.lit(rule.name)) for rule in rules]
        failed = F.filter(F.array(*checks).cast("array<string>"), lambda name: name.isNotNull())
        base = (counts["n_words"] < MIN_WORDS) | (
            counts["n_repeat_words"] * 100 > counts["n_words"] * MAX_REPEAT_PERCENT
        )
        named = [counts[name].alias(name) for name in COUNTS]
        whole = lambda f, b: F.struct(*named, b.alias("base_failed"), f.alias("failed_rules"), (~b & (F.size(f) == 0)).alias("kept"))
        return let(failed, lambda f: let(base, lambda b: whole(f, b)))

    def of_words(tokens: Column) -> Column:
        return let(_lines(text), lambda lines: let(_counts(text, tokens, lines), lambda c: ruled(c, tokens, lines)))

    return let(words(text), of_words)


COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_ellipsis_lines", "n_repeat_words", "n_stop_words",
    "n_letter_words",
)


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """_given, all columns of docs as a struct, and _verdict, the struct of counts and verdicts."""
    # Given columns go into one struct, so that a column of the input named like a count cannot clash.
    text = docs.select(F.struct("*").alias("_given"), F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    return text.select("_given", _verdict(F.col("_text"), rules).alias("_verdict"))


def quality_table(docs: DataFrame) -> DataFrame:
    """One row per document: the counts, base_failed and kept."""
    verdict = [F.col(f"_verdict.{name}").alias(name) for name in (*COUNTS, "base_failed", "kept")]
    return judged(docs.select("doc_id", "text")).select(F.col("_given.doc_id").alias("doc_id"), *verdict)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs, all their columns, that pass the base rule and every rule of the table."""
    return judged(docs).where("_verdict.kept").select("_given.*")
