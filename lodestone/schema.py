"""Column types that stages hand on, as DDL, and guards on them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lodestone.errors import ConsolidationError

RAW = (
    "record_id string, seq long, source_name string, source_type string, file_name string, file_path string, mime_type string, checksum_sha256 string, "
    "batch_id string, ingestion_timestamp timestamp, fieldnames array<string>, payload map<string,string>, raw_text string, tags array<string>"
)
EDUCATION_ITEM = "struct<text: string, institution: string, degree: string, field_of_study: string, date_text: string>"
EXPERIENCE_ITEM = "struct<text: string, title: string, organization: string, date_range_text: string>"
SKILL = "struct<name: string, category: string, years_of_experience: double, evidence: array<string>>"
EMPLOYMENT = "struct<company_name: string, title: string, start_date: date, end_date: date, is_current: boolean, description: string>"
EDUCATION = "struct<institution_name: string, degree: string, field_of_study: string, graduation_date: date>"
PROVENANCE = "struct<field_name: string, source_record_id: string, source_name: string, source_type: string, method: string, source_value: string>"


def require(df: DataFrame, columns: list[str], error: type[ConsolidationError]) -> DataFrame:
    """df, if it is a DataFrame that has the columns; else the error, before any job runs."""
    if not isinstance(df, DataFrame):
        raise error(f"a DataFrame is needed, not {type(df).__name__}")
    if missing := [c for c in columns if c not in df.columns]:
        raise error(f"columns are missing: {', '.join(missing)}")
    return df
