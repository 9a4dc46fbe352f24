"""Normalization of canonical records: one select."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone import schema
from lodestone.errors import NormalizationError
from lodestone.functions import normalizers as N
from lodestone.functions import patterns as P
from lodestone.functions import text as X
from lodestone.functions.dictionaries import skill_name, source_priority


def strings(items: Column) -> Column:
    return X.some(F.transform(items, X.clean))


def skill_records(items: Column) -> Column:
    names = X.distinct(F.transform(strings(items), skill_name))
    return F.transform(names, lambda n: F.struct(n.alias("name"), F.lit(None).cast("string").alias("category"), F.lit(None).cast("double").alias("years_of_experience"), X.no_strings().alias("evidence")))


def education_records(items: Column, strict: bool) -> Column:
    """Items with an institution."""
    made = F.transform(F.filter(items, lambda e: X.clean(e.institution_name).isNotNull()), lambda e: F.struct(X.clean(e.institution_name).alias("institution_name"), X.clean(e.degree_name).alias("degree"), X.clean(e.field_of_study).alias("field_of_study"), N.date(e.date_text, strict).alias("graduation_date")))
    return made


def employment_records(items: Column, strict: bool) -> Column:
    """Items with a company."""

    def record(e: Column) -> Column:
        make = lambda start, end, current: F.struct(X.clean(e.organization_name).alias("company_name"), X.clean(e.job_title).alias("title"), start.alias("start_date"), end.alias("end_date"), current.alias("is_current"), X.clean(e.raw_text).alias("description"))
        dated = X.let(N.date_range(e.date_range_text, strict), lambda d: make(d.start_date, d.end_date, d.is_current))
        none = F.lit(None).cast("date")
        return F.when(e.date_range_text.isNull(), make(none, none, F.lit(False))).otherwise(dated)

    return F.transform(F.filter(items, lambda e: X.clean(e.organization_name).isNotNull()), record)


def attributes() -> Column:
    """What has no field of its own; lists that are empty are null."""
    urls = F.col("urls_")
    listed = lambda items: F.when(F.size(items) > 0, items)
    has = lambda u, s: F.lower(u).contains(s)
    first = lambda keep: X.first(F.filter(urls, keep))
    return F.struct(
        listed(F.col("sentences_")).alias("source_sentences"),
        listed(urls).alias("urls"),
        first(lambda u: has(u, "github.com")).alias("github_url"),
        first(lambda u: has(u, "linkedin.com") & ~has(u, "github.com")).alias("linkedin_url"),
        first(lambda u: ~has(u, "linkedin.com") & ~has(u, "github.com") & ~has(u, "gitlab.com")).alias("personal_website_url"),
        listed(F.col("organizations_")).alias("organizations"),
    )


def normalize(canonical: DataFrame, strict_dates: bool = True) -> DataFrame:
    schema.require(canonical, ["record_id", "source_record_id", "seq", "source_name", "source_type", "full_name", "email_addresses", "phone_numbers", "skills", "education", "experience", "organizations", "locations", "urls", "sentences"], NormalizationError)
    staged = canonical.withColumns(
        {
            "name_": N.person_name(F.col("full_name")),
            "emails_": N.emails(F.col("email_addresses")),
            "phones_": N.phones(F.col("phone_numbers")),
            "jobs_": employment_records(F.col("experience"), strict_dates),
            "urls_": F.when(F.size("urls") > 0, X.distinct(F.transform(strings(F.col("urls")), X.with_scheme))),
            "sentences_": X.distinct(strings(F.col("sentences"))),
            "organizations_": X.distinct(strings(F.col("organizations"))),
            "place_": X.first(F.filter("locations", lambda x: x.rlike(P.NOT_SPACE))),
        }
    )
    first_name, last_name = N.name_parts(F.col("name_"))
    emails, phones, jobs = F.col("emails_"), F.col("phones_"), F.col("jobs_")
    linkedin = X.first(F.filter("urls_", lambda u: F.lower(u).contains("linkedin.com")))
    rest = lambda items: F.slice(items, F.lit(2), F.greatest(F.size(items), F.lit(1)))
    contact = F.struct(X.first(emails).alias("email"), X.first(phones).alias("phone"), rest(emails).alias("alternate_emails"), rest(phones).alias("alternate_phones"), X.canonical_url(linkedin).alias("linkedin_url"))
    source_id = F.coalesce(F.nullif(F.trim("source_record_id"), F.lit("")), F.col("record_id"))
    return staged.select(
        F.concat(F.lit("normalized::"), source_id).alias("normalized_id"),
        source_id.alias("source_record_id"),
        "seq",
        "source_name",
        "source_type",
        source_priority(F.col("source_type")).alias("source_priority"),
        F.col("name_").alias("full_name"),
        first_name.alias("first_name"),
        last_name.alias("last_name"),
        X.first(F.filter(F.transform(jobs, lambda j: j.title), lambda t: t.isNotNull())).alias("headline"),
        F.lit(None).cast("string").alias("summary"),
        contact.alias("contact"),
        N.location(F.col("place_")).alias("location"),
        skill_records(F.col("skills")).alias("skills"),
        jobs.cast(f"array<{schema.EMPLOYMENT}>").alias("work_experience"),
        education_records(F.col("education"), strict_dates).cast(f"array<{schema.EDUCATION}>").alias("education"),
        X.no_strings().alias("certifications"),
        X.no_strings().alias("languages"),
        attributes().alias("attributes"),
    )


def primary_email() -> Column:
    return F.col("contact.email")


def primary_identifier() -> Column:
    """The e-mail, else the phone, else the id."""
    return F.coalesce(F.col("contact.email"), F.col("contact.phone"), F.col("normalized_id"))


def has_minimum_identity() -> Column:
    """Whether there is a name, an e-mail or a phone."""
    return F.coalesce(F.col("full_name"), F.col("contact.email"), F.col("contact.phone")).isNotNull()
