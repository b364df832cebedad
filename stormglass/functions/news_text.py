"""Column expressions on article text. All are built-ins and stay in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from stormglass import fixed_values as V

_CASED = r"\p{Lu}\p{Ll}\p{Lt}"
# Marks a word start that is not preceded by a blank; removed after capitalising.
_MARK = "\u0001 "


def contains_any(text: Column, words: str) -> Column:
    """Whether one of the words, separated by |, occurs in the text.

    A search for bytes: about three times as fast as a pattern on long theme lists, which every
    raw article passes through.
    """
    return reduce(Column.__or__, [text.contains(word) for word in words.split("|")])


def first_match(text: Column, classes: list[tuple[str, str]], default: Column) -> Column:
    """Name of the first class one of whose words occurs in the text."""
    branches = [(contains_any(text, words), F.lit(name)) for name, words in classes]
    (condition, value), *rest = branches
    chain = reduce(lambda acc, b: acc.when(*b), rest, F.when(condition, value))
    return chain.otherwise(default)


def batch_category(themes: Column) -> Column:
    return first_match(themes, V.BATCH_CATEGORIES, F.lit(None).cast("string"))


def live_category(themes: Column) -> Column:
    return first_match(themes, V.LIVE_CATEGORIES, F.lit(V.LIVE_CATEGORY_OTHER))


def mentions_foreign_country(themes: Column) -> Column:
    return themes.rlike(V.NON_US_COUNTRY)


def negative_tone(tone: Column) -> Column:
    """Third value of the comma separated tone list; NULL when it is no number."""
    return F.get(F.split(tone, ","), F.lit(2)).try_cast("double")


def url_slug(url: Column) -> Column:
    """Last path part of a URL, up to its first dot."""
    last = F.substring_index(F.rtrim(url, F.lit("/")), "/", -1)
    return F.substring_index(last, ".", 1)


def slug_words(url: Column) -> Column:
    """Capitalised words of a URL, without digits and words below three letters."""
    slug = F.substring_index(url_slug(url), "?", 1)
    spaced = F.regexp_replace(F.translate(slug, "-_", "  "), r"\p{Nd}+", "")
    long_words = F.regexp_replace(spaced, r"(?<![^\s\p{Z}])[^\s\p{Z}]{1,2}(?![^\s\p{Z}])", " ")
    return F.initcap(F.trim(F.regexp_replace(long_words, r"[\s\p{Z}]+", " ")))


def long_enough(title: Column) -> Column:
    return F.length(title) > 15


def url_to_title(url: Column) -> Column:
    """Readable title from a URL; NULL when it would be short."""
    # A CASE would make the title twice, for the test and for the value.
    return F.get(F.filter(F.array(slug_words(url)), long_enough), F.lit(0))


def capitalise_after_non_letters(text: Column) -> Column:
    """Upper case for every letter that follows a non-letter, lower case for the rest."""
    marked = F.regexp_replace(text, f"(?<=[^{_CASED} ])(?=[{_CASED}])", _MARK)
    return F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))


def url_to_title_live(url: Column) -> Column:
    """Live headline: slug in title case, cut at 60 characters; the URL if there is no slug."""
    title = capitalise_after_non_letters(F.translate(url_slug(url), "-_", "  "))
    return F.left(F.coalesce(F.nullif(title, F.lit("")), url), F.lit(60))


def letters_only(text: Column) -> Column:
    return F.regexp_replace(text, "[^a-zA-Z]", "")


def good_live_title(title: Column) -> Column:
    return (
        (F.length(title) > 20)
        & title.contains(" ")
        & ~title.rlike(V.HEX_ONLY_TITLE)
        & ~title.rlike(V.NUMBERED_TITLE)
        & (F.length(letters_only(title)) > 10)
    )


def _free_of_web_remnants(title: Column) -> Column:
    return (
        ~title.rlike(V.WEB_REMNANT)
        & ~title.rlike(V.HEX_RUN)
        & title.contains(" ")
        & (F.length(letters_only(title)) > 15)
    )


def good_feed_title(title: Column) -> Column:
    more_than_digits = F.length(F.regexp_replace(title, r"[\d\s]", "")) > 5
    return more_than_digits & _free_of_web_remnants(title)


def good_archive_title(title: Column) -> Column:
    return (
        (F.length(title) > 20)
        & _free_of_web_remnants(title)
        & ~title.rlike(V.ARTICLE_PLACEHOLDER)
    )


def label_keywords(label: Column) -> Column:
    """Proper nouns of an event label, in lower case."""
    words = F.transform(F.regexp_extract_all(label, F.lit("[A-Z][a-z]+"), F.lit(0)), F.lower)
    return F.filter(words, lambda w: ~w.isin(V.LABEL_STOPWORDS))


def relevant_to_label(title: Column, label: Column) -> Column:
    """Title names a proper noun of the label and a conflict word; no proper noun keeps all."""
    nouns = label_keywords(label)
    lowered = F.lower(title)
    names_event = F.exists(nouns, lambda w: lowered.contains(w))
    return title.isNotNull() & (
        (F.size(nouns) == 0) | (names_event & lowered.rlike("|".join(V.CONFLICT_WORDS)))
    )
