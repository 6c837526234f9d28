"""Text expressions: normalisation, tokens, stop lists."""

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"(?U)\s+"

# Words that don't count as content.
STOP_BASE = (
    "a an and are as at be been but by for from has have he her his i in is it its of on or that the to was were will with you your "
    "this they we she him can do does did not no yes am all any some there their them so than then too very when where which who why "
    "how what would could should may might must shall up down out about into through over under again further more most other such "
    "only own same if because while"
).split()
STOP_MORE = "during before after above below between both each few".split()
STOP_PAIRS = "a an and are as at be but by for from has have in is it of on or that the to was were will with".split()
#: Content words of density and term counts; of neighbour themes; of lexical likeness.
STOP_TERMS, STOP_THEMES, STOP_LIKENESS = [*STOP_BASE, *STOP_MORE], STOP_BASE, STOP_PAIRS

# Characters stripped from both ends of a token.
STRIP_DENSITY = ".,!?;:()[]{}\"'-"
STRIP_TERMS = string.punctuation
STRIP_THEMES = ".,!?;:\"()[]{}"


def normalise(c: Column) -> Column:
    """Lower case, trimmed, runs of white space as one space; null as empty."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"(?U)^\s+|\s+$", ""), SPACE, " ")


def tokens(c: Column) -> Column:
    return F.filter(F.split(F.coalesce(c, F.lit("")), SPACE), lambda t: t != "")


def has_letter(t: Column) -> Column:
    return t.rlike(r"\p{L}")



def one_of(t: Column, words: list[str]) -> Column:
    return F.array_contains(F.lit(words), t)


def clean_words(c: Column, chars: str) -> Column:
    """Lower-case tokens stripped of chars that keep a letter."""
    return F.filter(F.transform(tokens(F.lower(c)), lambda t: F.btrim(t, F.lit(chars))), lambda t: has_letter(t))


def _themes(t: Column, stop: list[str], least: int) -> Column:
    kept = F.filter(t, lambda t: (F.length(F.btrim(t, F.lit(STRIP_THEMES))) >= least) & ~t.isin(stop) & has_letter(t))
    return F.transform(kept, lambda t: F.btrim(t, F.lit(STRIP_THEMES)))


def theme_words(c: Column, stop: list[str], least: int) -> Column:
    """Tokens of at least so many characters once stripped; the stop list is held against the unstripped token."""
    return _themes(tokens(F.lower(c)), stop, least)


def word_set(c: Column, least: int = 2) -> Column:
    """The distinct words that likeness compares. Each token is looked at once, however often it stands in the text."""
    t = F.array_distinct(F.split(F.lower(F.coalesce(c, F.lit(""))), SPACE))
    return F.array_distinct(_themes(t, STOP_LIKENESS, max(1, least)))


def set_likeness(x: Column, y: Column, method: str = "jaccard") -> Column:
    """Likeness of two sets of words: Jaccard, or twice the shared over the sum of sizes for `overlap`; 0 if either is empty."""
    both, sizes = F.size(F.array_intersect(x, y)), F.size(x) + F.size(y)
    if method == "jaccard":
        value = both / (sizes - both)
    elif method == "overlap":
        value = 2 * both / sizes
    else:
        raise ValueError(f"unknown likeness {method!r}")
    return F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(value)


def likeness(a: Column, b: Column, method: str = "jaccard", least: int = 2) -> Column:
    """Likeness of two texts' word sets. Where a text is compared more than once, make its word_set first."""
    return set_likeness(word_set(a, least), word_set(b, least), method)


def excerpt(c: Column, most: int = 200, dots: str = "...") -> Column:
    """One line of at most `most` characters for CSV: white space collapsed, cut with dots, double quotes doubled."""
    flat = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), SPACE, " "), "^ | $", "")
    cut = F.when(F.length(flat) > most, F.concat(F.substring(flat, 1, most - len(dots)), F.lit(dots))).otherwise(flat)
    return F.replace(cut, F.lit('"'), F.lit('""'))


def title_of(episode: Column) -> Column:
    """The fourth part of `Series - #NUM - DATE - Title` and what follows, else the whole id."""
    parts = F.split(episode, " - ")
    return F.when(F.size(parts) >= 4, F.array_join(F.slice(parts, 4, 1000), " - ")).otherwise(episode)


def date_of(episode: Column) -> Column:
    """The third part, if it has the form of a date (ten characters, dashes in place)."""
    part = F.try_element_at(F.split(episode, " - "), F.lit(3))
    return F.when((F.length(part) == 10) & (F.substring(part, 5, 1) == "-") & (F.substring(part, 8, 1) == "-"), part)
