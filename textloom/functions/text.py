"""Column functions on text: cleaning, measures, quality, cutting to whole sentences."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Word characters, letters and digits as Java and RE2 both understand them.
W, L, D = r"[\p{L}\p{N}_]", r"\p{L}", r"\p{Nd}"
SPACE = r"[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LINE_END = r"\r\n|[\n\x0b\f\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"

#: The most frequent short words of each language, for the guess of a text's language.
FUNCTION_WORDS = {
    "ca": "el la els les de del i que en un una per amb no es al més com però aquest són".split(),
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als".split(),
    "en": "the of and to in a is that for it on was with as by be at this are from".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur".split(),
    "it": "di e il la che in un a per è una del non si da con i le della al".split(),
    "pt": "de a o que e do da em um para com não uma os no se na por mais as dos".split(),
}


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Canonical composition; the JVM has no function for it."""
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFC", x))


def bind(value: Column, fn) -> Column:
    """fn(value), with the value computed once however often fn names it, also within lambdas."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def strip(c: Column) -> Column:
    """Without white space of any kind at its ends."""
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


def clean_text(c: Column, composed: bool = False) -> Column:
    """Composed (if it isn't already), without control characters (line ends stay), runs of blanks as one, at most one empty line in a row, stripped."""
    c = F.regexp_replace(c if composed else nfc(c), r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")
    return strip(F.regexp_replace(F.regexp_replace(c, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def unwrap_lines(c: Column) -> Column:
    """Words hyphenated over a line's end put together, single line breaks as spaces, leaders of dots as one space."""
    c = F.regexp_replace(c, rf"({W})-\n(?={W})", "$1")
    return F.regexp_replace(F.regexp_replace(c, r"(?<!\n)\n(?!\n)", " "), r"(?:\.\s?){4,}", " ")


def word_count(c: Column) -> Column:
    """Runs of what is no white space."""
    return F.regexp_count(c, F.lit(rf"(?:(?!{SPACE}).)+"))


def letter_ratio(c: Column) -> Column:
    return F.when(F.length(c) > 0, F.regexp_count(c, F.lit(L)) / F.length(c)).otherwise(F.lit(0.0))


def is_heading_line(c: Column) -> Column:
    s = strip(c)
    return (F.length(s) > 0) & ~s.rlike(r"^\s*(?:[-*•]|\d+[.)])\s+") & ~s.rlike(r"[.?!…]$") & (word_count(s) <= 10) & (F.length(s) <= 120)


def lines_of(c: Column) -> Column:
    """The lines of a text, without an empty one after a final line end."""
    parts = F.split(c, LINE_END)
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def text_quality(c: Column, cleaned: Column | None = None) -> Column:
    """A struct of the measures of a text, its score in 0..1 and its label; null for a null text."""
    chars = F.length(c)
    symbols = ratio(F.regexp_count(c, F.lit(rf"(?!{SPACE})[^\p{{L}}\p{{N}}]")), chars)
    numbers = ratio(F.regexp_count(c, F.lit(D)), chars)
    kept = F.least(F.lit(1.0), ratio(F.length(cleaned), chars)) if cleaned is not None else F.lit(1.0)
    counted = bind(lines_of(c), lambda lines: bind(F.filter(F.transform(lines, strip), lambda x: F.length(x) > 0), lambda filled: F.struct(F.size(lines).alias("n"), F.size(filled).alias("filled"), F.size(F.array_distinct(filled)).alias("distinct"), F.size(F.filter(filled, lambda x: (F.length(x) >= 20) & (letter_ratio(x) >= 0.35))).alias("useful"))))

    def measures(m: Column) -> Column:
        n, useful, symbols, numbers, kept = m["l"]["n"], m["l"]["useful"], m["symbols"], m["numbers"], m["kept"]
        repeated = F.when(m["l"]["filled"] > 0, 1 - m["l"]["distinct"] / m["l"]["filled"]).otherwise(F.when(chars > 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        score = (0.45 * ratio(useful, n) + 0.20 * (1 - symbols) + 0.15 * (1 - numbers) + 0.20 * (1 - repeated)) * kept
        score = F.round(F.when(chars > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), score))).otherwise(F.lit(0.0)), 6)
        return bind(score, lambda v: F.struct(
            chars.alias("characters"), m["words"].alias("words"), n.alias("lines"), useful.alias("useful_lines"), (n - useful).alias("garbage_lines"),
            F.round(symbols, 6).alias("symbol_ratio"), F.round(numbers, 6).alias("number_ratio"), F.round(repeated, 6).alias("repetition_ratio"),
            F.round(F.when(chars > 0, kept).otherwise(F.lit(0.0)), 6).alias("cleaning_ratio"), v.alias("quality_score"), quality_label(v).alias("quality_label"),
        ))

    parts = F.struct(counted.alias("l"), symbols.alias("symbols"), numbers.alias("numbers"), kept.alias("kept"), F.regexp_count(c, F.lit(rf"{W}+")).alias("words"))
    return F.when(c.isNotNull(), bind(parts, measures))


def quality_label(score: Column) -> Column:
    return F.when(score >= 0.75, "alta").when(score >= 0.45, "media").otherwise("baja")


def guess_language(c: Column) -> Column:
    """The language with the most function words in the text; `und` if it has none or is shorter than 20 characters."""
    def count(words: Column, own: list[str]) -> Column:
        return F.size(F.filter(words, lambda w: w.isin(own)))

    def best(words: Column) -> Column:
        return F.greatest(*(F.struct(count(words, own).alias("n"), F.lit(-k).alias("k"), F.lit(lang).alias("lang")) for k, (lang, own) in enumerate(sorted(FUNCTION_WORDS.items()))))

    words = F.regexp_extract_all(F.lower(c), F.lit(rf"({L}+)"), 1)
    name = bind(bind(words, best), lambda b: F.when(b["n"] == 0, "und").otherwise(b["lang"]))
    return F.when((F.length(strip(c)) < 20) | c.isNull(), "und").otherwise(name)


def truncate_to_sentences(c: Column, most: int = 250) -> Column:
    """The text if it has at most `most` words; else its first whole sentences within the limit, or its first `most` words if even one is longer."""
    sentences = F.transform(F.split(strip(c), rf"(?<=[.!?]){SPACE}+"), lambda s: F.struct(s.alias("s"), word_count(s).alias("w")))
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("n"), F.lit(False).alias("over"))

    def step(a: Column, x: Column) -> Column:
        over = a["over"] | (a["n"] + x["w"] > most)
        kept = F.when(over, a["kept"]).otherwise(F.concat(a["kept"], F.array(x["s"])))
        return F.struct(kept.alias("kept"), F.when(over, a["n"]).otherwise(a["n"] + x["w"]).alias("n"), over.alias("over"))

    whole = F.array_join(F.aggregate(sentences, start, step)["kept"], " ")
    first = F.array_join(F.slice(F.split(strip(c), rf"{SPACE}+"), 1, most), " ")
    return F.when(word_count(c) <= most, c).otherwise(bind(whole, lambda w: F.when(F.length(w) > 0, w).otherwise(first)))


#: What ends a sentence, what may close after it, and which letters tell how a sentence begins.
_MARKS, _CLOSING, _LETTERS = ".!?…", "])}\"'»”’", "A-Za-zÀ-ÖØ-öø-ÿ"
_SENTENCE_END = re.compile(rf"[{_MARKS}](?=[{re.escape(_CLOSING)}]*(?!\S))")
_FIRST_LETTER = re.compile(f"[{_LETTERS}]")
_BEHIND_END = re.compile(rf"[ \t\r\n{re.escape(_CLOSING)}]*")


def whole_sentences(text: str | None, most: int = 250) -> str | None:
    """The longest stretch of at most `most` words from the start to the end of a sentence, without a broken sentence before it; None if there is none.

    Ends of sentences and beginnings of words are listed once; the last end within the limit is found by halving, and
    from the front beginnings are passed over as long as their first letter is small and another one is left.
    """
    ends = [m.end() for m in _SENTENCE_END.finditer(text or "")]
    words = [m.start() for m in re.finditer(r"\S+", text or "")]
    n = bisect_right(ends, most, key=lambda e: bisect_left(words, e))
    if not n:
        return None
    stop, begin = ends[n - 1], words[0]
    while (letter := _FIRST_LETTER.search(text, begin, stop)) and letter.group().islower():
        after = ends[min(bisect_left(ends, letter.end() + 1, 0, n), n - 1)]
        following = _BEHIND_END.match(text, after, stop).end()
        if following >= stop:
            break
        begin = following
    return text[begin:stop]


@F.pandas_udf(T.StringType())
def complete_sentences(s: pd.Series) -> pd.Series:
    return s.map(whole_sentences)
