"""Column functions that normalize names, e-mails, phones, locations and dates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions import patterns as P
from lodestone.functions import text as X
from lodestone.functions.dictionaries import NAME_SUFFIXES, country_name, known_skill

DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "MMM d yyyy", "MMMM d yyyy")
MONTH_FORMATS = ("MMM yyyy", "MMMM yyyy")


def person_name(value: Column) -> Column:
    """Suffixes such as Jr and III in upper case without their dot, short all-capital words as they are, other words capitalized."""

    def word(w: Column) -> Column:
        bare = X.strip(F.lower(w), ".")
        acronym = (F.length(w) <= 3) & w.rlike(r"\p{Lu}") & ~w.rlike(r"\p{Ll}")
        return F.when(bare.isin(NAME_SUFFIXES), F.rtrim(F.upper(w), F.lit("."))).when(acronym, w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 20))))

    return F.nullif(F.array_join(F.transform(F.split(X.clean(value), " "), word), " "), F.lit(""))


def name_parts(name: Column) -> tuple[Column, Column]:
    """First and last name; one word is a first name."""
    parts = F.split(name, " ")
    return F.try_element_at(parts, F.lit(1)), F.when(F.size(parts) > 1, F.element_at(parts, -1))


def emails(values: Column) -> Column:
    """Well-formed addresses in lower case, each once."""
    return X.distinct(F.filter(F.transform(values, lambda v: F.lower(X.squeeze(v))), lambda v: v.rlike(P.EMAIL_WHOLE)))


def phone(value: Column) -> Column:
    """Digits, with a plus sign if it or 00 stands before them or there are at least 11; null unless there are 7 to 15."""
    return X.let(X.squeeze(value), lambda text: X.let(F.regexp_replace(text, r"\D", ""), lambda digits: _international(text, digits)))


def _international(text: Column, digits: Column) -> Column:
    n = F.length(digits)
    plus = F.concat(F.lit("+"), digits)
    international = F.when(text.startswith("+"), plus).when(digits.startswith("00") & (n > 9), F.concat(F.lit("+"), F.substring(digits, 3, 15))).when(n >= 11, plus)
    return F.when((n >= 7) & (n <= 15), F.coalesce(international, digits))


def phones(values: Column) -> Column:
    return X.distinct(F.transform(values, phone))


def location(value: Column) -> Column:
    """city, state_or_region, country, postal_code and raw_location of a text with commas; all null if it names a skill."""
    named = lambda raw: F.when(~known_skill(raw), raw)
    return X.let(X.let(X.clean(value), named), lambda raw: X.let(X.some(F.transform(F.split(raw, ","), X.trim)), lambda parts: _place(raw, parts)))


def _place(raw: Column, parts: Column) -> Column:
    n = F.size(parts)
    country = country_name(F.try_element_at(parts, F.lit(-1)))
    state = F.when((n > 2) | ((n == 2) & country.isNull()), F.try_element_at(parts, F.lit(2)))
    none = F.lit(None).cast("string")
    return F.struct(X.first(parts).alias("city"), state.alias("state_or_region"), country.alias("country"), none.alias("postal_code"), raw.alias("raw_location"))


def date(value: Column, strict: bool = True) -> Column:
    """A year gives its first day, a full date itself; a month with a year its first day, but null if strict."""
    return X.let(X.clean(value), lambda text: _date(text, strict))


def _date(text: Column, strict: bool) -> Column:
    formats = DATE_FORMATS + (() if strict else MONTH_FORMATS)
    # A regular expression guards each format, so no exception is made for other texts.
    full = lambda plain: F.coalesce(*(F.when(plain.rlike(_shape(f)), F.try_to_date(plain, f)) for f in formats))
    return F.when(text.rlike(r"^(?:19|20)\d{2}$"), F.make_date(F.when(text.rlike(r"^\d{4}$"), text).cast("int"), F.lit(1), F.lit(1))).otherwise(X.let(_plain_date(text), full))


def _plain_date(text: Column) -> Column:
    """The text with months capitalized, and without ordinal endings and the dots of shortened months."""
    cardinal = F.regexp_replace(text, r"(?i)\b(\d{1,2})(?:st|nd|rd|th)\b", "$1")
    return F.initcap(F.regexp_replace(F.regexp_replace(cardinal, r"(?i)\b([a-z]{3,4})\.", "$1"), r"(?i)\bsept\b", "sep"))


def _shape(date_format: str) -> str:
    """A pattern that the format's dates have."""
    fields = {"yyyy": r"\d{4}", "MMMM": "[A-Z][a-z]{2,8}", "MMM": "[A-Z][a-z]{2}", "MM": r"\d{2}", "dd": r"\d{2}", "d": r"\d{1,2}"}
    return "^" + re.sub("|".join(fields), lambda m: fields[m[0]], date_format) + "$"


def date_range(value: Column, strict: bool = True) -> Column:
    """start_date, end_date and is_current of a text; the first separator found counts, in the order " - ", " to ", hyphen, en dash, em dash."""
    cut = lambda text, s: F.when(text.contains(s), F.split(text, "\\Q" + s + "\\E", 2))
    parts = X.let(X.clean(value), lambda text: F.coalesce(*(cut(text, s) for s in (" - ", " to ", "-", "–", "—")), F.array(text)))
    return X.let(parts, lambda found: _dates(F.trim(X.first(found)), F.trim(F.try_element_at(found, F.lit(2))), strict))


def _dates(start: Column, end: Column, strict: bool) -> Column:
    current = F.coalesce(F.lower(end).isin("present", "current", "now"), F.lit(False))
    return F.struct(date(start, strict).alias("start_date"), F.when(~current, date(end, strict)).alias("end_date"), current.alias("is_current"))
