"""Fields of structured records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone import schema
from lodestone.errors import ExtractionError
from lodestone.functions import text as X
from lodestone.functions.dictionaries import skill_name

KEYS = ["record_id", "seq", "source_name", "source_type"]


def one(value: Column) -> Column:
    """A list of the value, or an empty one if there is none."""
    return F.when(value.isNotNull() & (value != ""), F.array(value)).otherwise(X.no_strings())


def split_skills(value: Column) -> Column:
    """Canonical names of a comma list, in order, repeats kept."""
    return F.coalesce(F.transform(X.some(F.transform(F.split(value, ","), X.trim)), skill_name), X.no_strings())


def experience(title: Column, company: Column, raw_text: Column) -> Column:
    """One item if there is a title or a company."""
    item = F.struct(F.coalesce(raw_text, F.lit("")).alias("text"), title.alias("title"), company.alias("organization"), F.lit(None).cast("string").alias("date_range_text"))
    there = F.coalesce(title != "", F.lit(False)) | F.coalesce(company != "", F.lit(False))
    return F.when(there, F.array(item)).otherwise(F.array().cast(f"array<{schema.EXPERIENCE_ITEM}>"))


def extract_structured(raw: DataFrame) -> DataFrame:
    """One row of extracted fields per structured record."""
    schema.require(raw, [*KEYS, "payload", "raw_text"], ExtractionError)
    cell = lambda c: F.col("payload")[c]
    return raw.select(
        *KEYS,
        cell("name").alias("name"),
        one(cell("email")).alias("emails"),
        one(cell("phone")).alias("phone_numbers"),
        split_skills(cell("skills")).alias("skills"),
        F.array().cast(f"array<{schema.EDUCATION_ITEM}>").alias("education"),
        experience(cell("title"), cell("company"), F.col("raw_text")).alias("experience"),
        one(cell("company")).alias("organizations"),
        one(cell("location")).alias("locations"),
        X.no_strings().alias("urls"),
        one(F.col("raw_text")).alias("sentences"),
    )
