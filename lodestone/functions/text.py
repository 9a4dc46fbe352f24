"""Column functions over texts and lists of texts. All are built-in expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions import patterns as P


def no_strings() -> Column:
    return F.array().cast("array<string>")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, however often use names it. Keeps nested expressions from growing without end."""
    return F.get(F.transform(F.array_repeat(value, 1), lambda v: use(v)), F.lit(0))


def trim(text: Column) -> Column:
    return F.trim(text)


def squeeze(text: Column) -> Column:
    """White space collapsed and trimmed."""
    return F.trim(F.regexp_replace(text, P.RAGGED_SPACE, " "))


def filled(text: Column) -> Column:
    """The text, or null if it is empty. Unlike nullif, which inside a list function is expanded to two copies, it computes the text once."""
    return F.get(F.array_remove(F.array(text), ""), F.lit(0))


def clean(text: Column) -> Column:
    """White space collapsed and trimmed; nothing left gives null."""
    return F.when(text.rlike(P.NOT_SPACE), squeeze(text))


def strip(text: Column, characters: str) -> Column:
    return F.btrim(text, F.lit(characters))


def some(items: Column) -> Column:
    """The list without nulls and empty texts."""
    return F.filter(items, lambda x: x.isNotNull() & (x != ""))


def distinct_by(items: Column, key: Callable[[Column], Column]) -> Column:
    """The items whose key no earlier item has, in order."""
    # Equal keys are neighbours once sorted, so a long list takes no time for each pair of items.
    sort = lambda keys: F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    new = lambda found, s: F.transform(F.array_sort(F.transform(F.filter(s, lambda x, j: (j == 0) | (x.k != F.get(s, j - 1).k)), lambda x: x.i)), lambda i: F.get(found, i))
    all_new = lambda keys: F.size(F.array_distinct(keys)) == F.size(keys)
    by_key = lambda found: let(F.transform(found, lambda x: key(x)), lambda keys: F.when(all_new(keys), found).otherwise(let(sort(keys), lambda s: new(found, s))))
    return let(items, lambda found: F.when(F.size(found) <= 1, found).otherwise(by_key(found)))


def distinct(items: Column) -> Column:
    """Texts that no earlier text equals but for case, in order; nulls and empty texts go."""
    return distinct_by(some(items), F.lower)


def first(items: Column) -> Column:
    return F.try_element_at(items, F.lit(1))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), no_strings())


def match(text: Column, pattern: str, group: int = 0) -> Column:
    """The group of the first match, or null."""
    return filled(F.regexp_extract(text, pattern, group))


def any_in(text: Column, words: list[str]) -> Column:
    """Whether the text has any of the words anywhere."""
    return reduce(lambda a, b: a | b, (text.contains(w) for w in words))


def lines(text: Column) -> Column:
    """Non-blank lines, white space collapsed."""
    return some(F.transform(F.split(text, P.LINE_BREAK), squeeze))


def sentences(text: Column) -> Column:
    """Sentences by end marks and the white space after them."""
    return some(F.transform(F.split(text, P.SENTENCE_BREAK), squeeze))


def words(text: Column) -> Column:
    return some(F.split(text, P.SPACE))


def letters(text: Column) -> Column:
    """Runs of ASCII letters, in lower case."""
    return F.transform(matches(text, "[A-Za-z]+"), F.lower)


def capital(text: Column) -> Column:
    """Whether the text begins with an upper-case letter."""
    return text.rlike(r"^\p{Lu}")


def with_scheme(url: Column) -> Column:
    return F.when(url.contains("://"), url).otherwise(F.concat(F.lit("https://"), url))


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, and a slash after a bare host; null if there is no http host."""
    return let(url, _canonical_url)


def _canonical_url(url: Column) -> Column:
    scheme, host, rest = (F.regexp_extract(url, r"^(?i)(https?)://([^/?#\s]+)(\S*)$", k) for k in (1, 2, 3))
    slash = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(host != "", F.concat(F.lower(scheme), F.lit("://"), F.lower(host), slash))
