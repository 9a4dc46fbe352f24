"""Fields of free text, by rules. All are built-in expressions: lists are built in stages, so each is computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone import schema
from lodestone.errors import ExtractionError
from lodestone.functions import dictionaries as D
from lodestone.functions import patterns as P
from lodestone.functions import text as X
from lodestone.operators.extract_structured import KEYS

_EDGES = " ,:-"


def emails(text: Column) -> Column:
    return X.distinct(F.transform(X.matches(text, P.EMAIL), X.squeeze))


def phones(text: Column) -> Column:
    """Numbers of 7 to 15 digits as they stand."""
    found = F.transform(X.matches(text, P.PHONE), lambda m: X.strip(X.squeeze(m), ".,;"))
    n = lambda m: F.length(F.regexp_replace(m, r"\D", ""))
    return X.distinct(F.transform(F.filter(found, lambda m: (n(m) >= 7) & (n(m) <= 15)), lambda m: F.trim(F.ltrim(m, F.lit(":")))))


def urls(text: Column) -> Column:
    """URLs, each with a scheme."""
    return X.distinct(F.transform(X.matches(text, P.URL), lambda m: X.with_scheme(X.squeeze(m))))


def skills(text: Column) -> Column:
    """Canonical names of the aliases that stand alone in the text, longest alias first, each once."""
    # contains is far cheaper than a regular expression, and false for most aliases; the patterns are constants, compiled once
    alone = lambda low, alias: low.contains(alias) & low.rlike(rf"(?<![A-Za-z0-9])\Q{alias}\E(?![A-Za-z0-9])")
    named = lambda low: F.array(*(F.when(alone(low, alias), F.lit(D.SKILL_ALIASES[alias])) for alias in D.MATCH_ORDER))
    return F.coalesce(X.let(F.lower(text), lambda low: F.array_distinct(F.array_compact(named(low)))), X.no_strings())


def sections(lines: Column) -> Column:
    """Lines of each section as a map. A line that begins with a header opens its section and is not part of it; a header that comes again goes on with its section."""
    marked = F.array_join(F.transform(lines, lambda line: F.when(line.rlike(P.SECTION), F.concat(F.lit("\x01"), line)).otherwise(line)), "\n")
    held = lambda chunk: X.let(F.split(chunk, "\n"), lambda found: F.struct(D.lookup(D.SECTION_NAMES, X.match(F.lower(X.first(found)), P.SECTION, 1)).alias("name"), F.filter(F.slice(found, 2, 1 << 30), lambda line: line != "").alias("lines")))
    chunks = F.split(marked, "\x01")
    by_name = lambda parts: F.map_from_entries(F.transform(F.array_distinct(F.transform(parts, lambda p: p["name"])), lambda n: F.struct(n, F.flatten(F.transform(F.filter(parts, lambda p: p["name"] == n), lambda p: p["lines"])))))
    return X.let(F.transform(F.slice(chunks, 2, 1 << 30), held), by_name)


def section_or_all(lines: Column, by_section: Column, name: str) -> Column:
    inside = F.try_element_at(by_section, F.lit(name))
    return F.when(F.size(inside) > 0, inside).otherwise(lines)


def person(lines: Column) -> Column:
    """The first of the first three lines with two to four words, no at sign and no digit, whose words of letters are capitalized."""
    named = lambda w: ~w.rlike(r"^[\p{L}.]*\p{L}[\p{L}.]*$") | X.capital(w)
    good = lambda line: ~line.rlike(r"[@\p{Nd}]") & F.size(F.split(line, " ")).between(2, 4) & F.forall(F.split(line, " "), named)
    return X.first(F.filter(F.slice(lines, 1, 3), good))


def organizations(sentences: Column) -> Column:
    """Pairs of adjacent capitalized words that have a company word somewhere. Only sentences that have one are split, each once."""

    def pairs(w: Column) -> Column:
        both = F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.struct(x.alias("a"), F.get(w, i + 1).alias("b")))
        good = F.filter(both, lambda p: X.capital(p.a) & X.capital(p.b) & X.any_in(F.lower(F.concat_ws(" ", p.a, p.b)), D.ORGANIZATION_WORDS))
        return F.transform(good, lambda p: F.concat_ws(" ", p.a, p.b))

    named = F.filter(sentences, lambda s: X.let(F.lower(s), lambda low: X.any_in(low, D.ORGANIZATION_WORDS)))
    return X.distinct(F.flatten(F.transform(named, lambda s: X.let(F.split(s, " "), pairs))))


def place_mentions(sentences: Column) -> Column:
    """Capitalized words after in, at, from or based, and what follows a location label. Only sentences that have these are split, each once."""

    def mentions(w: Column) -> Column:
        bare = lambda x: X.strip(x, ",")
        triples = F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.struct(x.alias("p"), bare(F.get(w, i + 1)).alias("a"), F.get(w, i + 2).alias("b")))
        good = F.filter(triples, lambda t: F.lower(t.p).isin(D.PLACE_PREPOSITIONS) & X.capital(t.a))
        return F.transform(good, lambda t: F.when(X.capital(t.b), F.concat_ws(" ", t.a, bare(t.b))).otherwise(t.a))

    both = lambda s: F.concat(F.when(s.rlike(P.PLACE_AFTER), X.let(F.split(s, " "), mentions)).otherwise(X.no_strings()), labels(s))
    return X.distinct(F.flatten(F.transform(sentences, both)))


def labels(text: Column) -> Column:
    """What follows a location label."""
    labelled = X.let(F.lower(text), lambda low: X.any_in(low, D.LOCATION_LABELS))
    return F.when(labelled, X.matches(text, P.LOCATION_LABEL, 1)).otherwise(X.no_strings())


def clean_entity(value: Column) -> Column:
    """Without a year before it and without what a section word begins; null if nothing is left."""
    bare = X.strip(F.regexp_replace(value, P.DATE_PREFIX, ""), _EDGES)
    return X.let(X.strip(F.element_at(F.split(bare, P.SECTION_WORD, 2), 1), _EDGES), X.clean)


def is_entity(value: Column) -> Column:
    """Whether it could name a company or school: it has letters, is not all skills and has no degree or certification word."""
    return X.let(X.letters(value), _is_entity)


def _is_entity(w: Column) -> Column:
    return F.coalesce((F.size(w) > 0) & ~F.forall(w, D.known_skill) & ~F.arrays_overlap(w, D.strings(D.CERTIFICATION_WORDS + D.DEGREE_WORDS)), F.lit(False))


def is_place(value: Column) -> Column:
    """Whether it could name a place."""
    return X.let(X.squeeze(value), lambda text: X.let(X.letters(text), lambda w: _is_place(text, w)))


def _is_place(text: Column, w: Column) -> Column:
    other = D.strings(D.INSTITUTION_WORDS + D.CERTIFICATION_WORDS + D.DEGREE_WORDS)
    shouted = text.rlike(r"\p{Lu}") & ~text.rlike(r"\p{Ll}") & (F.size(w) <= 2)
    return (text != "") & ~F.lower(text).rlike("https?://|@") & (F.size(F.split(text, " ")) <= 6) & (F.size(w) > 0) & ~F.forall(w, D.known_skill) & ~F.arrays_overlap(w, other) & ~shouted


def header_places(lines: Column) -> Column:
    """Parts with a comma of the lines before any section, of the first six, without contacts."""
    top = F.slice(lines, 1, 6)
    stop = F.array_position(F.transform(top, lambda line: line.rlike(P.SECTION)), True)
    block = F.when(stop > 0, F.slice(top, F.lit(1), (stop - 1).cast("int"))).otherwise(top)

    def parts(line: Column) -> Column:
        for pattern in (P.EMAIL, P.PHONE, P.URL):
            line = F.regexp_replace(line, pattern, " ")
        return F.transform(F.filter(F.split(line, r"[|/]"), lambda s: s.contains(",")), lambda s: X.strip(s, " -,:"))

    return F.flatten(F.transform(F.filter(block, lambda line: line.contains(",")), parts))


def labelled_places(items: Column) -> Column:
    return F.flatten(F.transform(items, lambda s: F.transform(labels(s), lambda m: X.strip(m, " -,:"))))


def sentence_places(sentences: Column, keywords: list[str]) -> Column:
    """Of sentences with a keyword: labelled places and the last two parts between commas."""

    def places(s: Column) -> Column:
        last = lambda parts: F.when(F.size(parts) >= 2, F.array(F.concat_ws(", ", F.element_at(parts, -2), F.element_at(parts, -1)))).otherwise(X.no_strings())
        return F.concat(labelled_places(F.array(s)), X.let(X.some(F.transform(F.split(s, ","), X.trim)), last))

    return F.flatten(F.transform(F.filter(sentences, lambda s: X.let(F.lower(s), lambda low: X.any_in(low, keywords))), places))


def places(lines: Column, sentences: Column, mentions: Column) -> Column:
    """Places of the header, of labels, of mentions and of experience and education sentences, in this order."""
    found = F.concat(header_places(lines), labelled_places(lines), mentions, sentence_places(sentences, D.EXPERIENCE_WORDS), sentence_places(sentences, D.EDUCATION_WORDS))
    return X.distinct(F.filter(found, is_place))


def contained(text: Column, names: Column) -> Column:
    return X.let(F.lower(text), lambda low: F.filter(names, lambda n: low.contains(F.lower(n))))


def degree(line: Column) -> Column:
    """The first degree word that the line has anywhere."""
    return X.let(F.lower(line), lambda low: X.first(F.filter(D.strings(D.DEGREE_WORDS), lambda w: low.contains(w))))


def institution(line: Column, known: Column) -> Column:
    """What follows at or from, else the first known organization in the line."""
    others = F.filter(F.transform(contained(line, known), clean_entity), is_entity)
    return X.let(clean_entity(X.match(line, P.AT_OR_FROM, 1)), lambda named: F.when(is_entity(named), named).otherwise(X.first(others)))


def field_of_study(line: Column) -> Column:
    """What stands between the degree and at, from, in or a year, if it has six words at most."""
    return X.let(degree(line), lambda d: X.let(_after(line, d), _study))


def _study(tail: Column) -> Column:
    cut = F.element_at(F.split(F.element_at(F.split(tail, P.STUDY_END, 2), 1), P.YEAR, 2), 1)
    return X.let(X.let(X.strip(cut, _EDGES), X.clean), lambda text: F.when(F.size(F.split(text, " ")) <= 6, text))


def _after(text: Column, word: Column) -> Column:
    """What follows the first place of a word, in any case."""
    return F.substring(text, F.position(word, F.lower(text)) + F.length(word), F.length(text))


def education(lines: Column, known: Column) -> Column:
    item = lambda s: F.struct(s.alias("text"), institution(s, known).alias("institution"), degree(s).alias("degree"), field_of_study(s).alias("field_of_study"), F.coalesce(X.let(X.match(s, P.DATE_RANGE), X.clean), X.match(s, P.YEAR)).alias("date_text"))
    items = F.transform(F.filter(lines, lambda s: X.let(F.lower(s), lambda low: X.any_in(low, D.EDUCATION_WORDS))), item)
    return F.filter(items, lambda e: F.coalesce(e.institution, e.degree, e.field_of_study, e.date_text).isNotNull())


def experience_item(line: Column, known: Column) -> Column:
    """Title, organization and dates of a line: "title, organization dates", else "worked at organization from dates", else a known organization and what is before it."""
    without = lambda dates: F.when(dates.isNotNull(), X.strip(F.replace(line, dates, F.lit("")), " ,-")).otherwise(line)
    parts = lambda dates, rest: F.struct(
        dates.alias("dates"),
        rest.alias("rest"),
        clean_entity(X.match(rest, P.TITLE_ORGANIZATION, 1)).alias("title"),
        clean_entity(X.match(rest, P.TITLE_ORGANIZATION, 2)).alias("company"),
        X.match(rest, P.TITLE_ORGANIZATION, 3).alias("tail"),
        clean_entity(X.match(line, P.WORKED_AT, 1)).alias("worked"),
        clean_entity(X.first(contained(line, known))).alias("other"),
    )
    found = X.let(X.let(X.match(line, P.DATE_RANGE), X.clean), lambda dates: X.let(without(dates), lambda rest: parts(dates, rest)))
    return X.let(found, lambda p: _experience_item(line, p))


def _experience_item(line: Column, p: Column) -> Column:
    none = F.lit(None).cast("string")
    make = lambda t, o, d: F.struct(line.alias("text"), t.alias("title"), o.alias("organization"), d.alias("date_range_text"))
    before = F.position(F.lower(p.other), F.lower(p.rest))
    prefix = F.nullif(X.strip(F.substring(p.rest, F.lit(1), before - 1), " ,-"), F.lit(""))
    return (
        F.when(is_entity(p.company), make(p.title, p.company, F.coalesce(p.dates, p.tail)))
        .when(is_entity(p.worked), make(none, p.worked, F.coalesce(p.dates, X.match(line, P.WORKED_AT, 2))))
        .when(is_entity(p.other), make(F.when((before > 1) & (F.size(F.split(prefix, P.SPACE)) <= 8), prefix), p.other, p.dates))
        .otherwise(make(none, none, p.dates))
    )


def experience(lines: Column, known: Column) -> Column:
    bullet = lambda s: F.substring(s, 1, 1).isin(*P.BULLETS)
    there = F.filter(lines, lambda s: ~bullet(s) & (X.let(F.lower(s), lambda low: X.any_in(low, D.EXPERIENCE_WORDS)) | (s.rlike(P.FOUR_DIGITS) & s.rlike(P.DATE_RANGE))))
    return F.filter(F.transform(there, lambda s: experience_item(s, known)), lambda e: F.coalesce(e.title, e.organization, e.date_range_text).isNotNull())


def extract_text(raw: DataFrame) -> DataFrame:
    """One row of extracted fields per document."""
    schema.require(raw, [*KEYS, "raw_text"], ExtractionError)
    text = F.col("raw_text")
    staged = raw.select(*KEYS, "raw_text", X.lines(text).alias("lines"), X.sentences(text).alias("sentences"))
    staged = staged.withColumns({"by_section": sections(F.col("lines")), "organizations": organizations(F.col("sentences")), "mentions": place_mentions(F.col("sentences"))})
    lines, by_section, known = F.col("lines"), F.col("by_section"), F.col("organizations")
    return staged.select(
        *KEYS,
        person(lines).alias("name"),
        emails(text).alias("emails"),
        phones(text).alias("phone_numbers"),
        skills(text).alias("skills"),
        education(section_or_all(lines, by_section, "education"), known).cast(f"array<{schema.EDUCATION_ITEM}>").alias("education"),
        experience(section_or_all(lines, by_section, "experience"), known).cast(f"array<{schema.EXPERIENCE_ITEM}>").alias("experience"),
        "organizations",
        places(lines, F.col("sentences"), F.col("mentions")).alias("locations"),
        urls(text).alias("urls"),
        "sentences",
    )
