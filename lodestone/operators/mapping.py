"""Canonical mapping: extracted fields under their canonical names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone import schema
from lodestone.errors import MappingError
from lodestone.operators.extract_structured import KEYS

VERSION = "1.0"


def to_canonical(extracted: DataFrame) -> DataFrame:
    schema.require(extracted, [*KEYS, "name", "emails", "phone_numbers", "skills", "education", "experience", "organizations", "locations", "urls", "sentences"], MappingError)
    named = F.col("record_id").isNotNull() & (F.trim("record_id") != "") & F.col("source_name").isNotNull() & (F.trim("source_name") != "")
    education = F.transform("education", lambda e: F.struct(e.text.alias("raw_text"), e.institution.alias("institution_name"), e.degree.alias("degree_name"), e.field_of_study.alias("field_of_study"), e.date_text.alias("date_text")))
    experience = F.transform("experience", lambda e: F.struct(e.text.alias("raw_text"), e.title.alias("job_title"), e.organization.alias("organization_name"), e.date_range_text.alias("date_range_text")))
    return extracted.select(
        F.when(named, F.col("record_id")).otherwise(F.raise_error(F.lit("a record has no id or no source name"))).alias("record_id"),
        "seq",
        "source_name",
        "source_type",
        F.col("record_id").alias("source_record_id"),
        F.lit(VERSION).alias("canonical_schema_version"),
        F.col("name").alias("full_name"),
        F.col("emails").alias("email_addresses"),
        "phone_numbers",
        "skills",
        education.alias("education"),
        experience.alias("experience"),
        "organizations",
        "locations",
        "urls",
        "sentences",
        F.nullif(F.array_join("sentences", "\n"), F.lit("")).alias("raw_text"),
        F.array(F.lit("canonical")).alias("tags"),
    )
