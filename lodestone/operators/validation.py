"""Input validation: predicates that give issues. Only fatal issues drop a record."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone import schema
from lodestone.errors import ConfigurationError, ValidationError
from lodestone.functions import patterns as P
from lodestone.functions.dictionaries import SOURCE_TYPES, strings
from lodestone.sources.recruiter_csv import REQUIRED

NEEDED_VALUES = ["email", "name"]
SEVERITIES = ["fatal", "error", "warning", "info"]
NEEDS = ["record_id", "source_type", "file_name", "fieldnames", "payload", "raw_text"]


def _issue(code: str, severity: str, field: str | None, message: Column | str, when: Column) -> Column:
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(when, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.lit(field).cast("string").alias("field"), text.alias("message")))


def _checks() -> list[tuple]:
    """(code, severity, field, message, when it holds) of every check, in a fixed order."""
    kind, payload = F.col("source_type"), F.col("payload")
    is_csv = kind == "recruiter_csv"
    suffix = F.lower(F.regexp_extract("file_name", r"(\.[^.]+)$", 1))
    named = F.col("file_name").isNotNull()
    cell = lambda c: payload[c]
    has = lambda c: cell(c).isNotNull() & (F.trim(cell(c)) != "")
    lacking = F.array_except(strings(REQUIRED), F.coalesce("fieldnames", F.array().cast("array<string>")))
    digits = F.length(F.regexp_replace(cell("phone"), r"\D", ""))
    blank_text = F.col("raw_text").isNotNull() & ~F.col("raw_text").rlike(P.NOT_SPACE)
    return [
        ("unsupported_source_type", "fatal", "source_type", "source type is not supported", ~F.coalesce(kind.isin(SOURCE_TYPES), F.lit(False))),
        ("unsupported_csv_file_type", "fatal", "file_name", "recruiter files end in .csv", is_csv & named & (suffix != ".csv")),
        ("unsupported_resume_file_type", "fatal", "file_name", "résumé files end in .pdf or .docx", kind.startswith("resume_") & named & ~suffix.isin(".pdf", ".docx")),
        ("empty_record", "fatal", None, "record has no content", F.coalesce(F.size("payload") <= 0, F.lit(True)) | F.coalesce(blank_text, F.lit(False))),
        ("missing_csv_fieldnames", "fatal", "fieldnames", "record has no column names", is_csv & F.coalesce(F.size("fieldnames") <= 0, F.lit(True))),
        ("missing_required_columns", "fatal", "fieldnames", F.concat(F.lit("missing columns: "), F.array_join(F.array_sort(lacking), ", ")), is_csv & (F.size("fieldnames") > 0) & (F.size(lacking) > 0)),
        *(("missing_required_value", "error", c, f"{c} has no value", is_csv & ~F.coalesce(has(c), F.lit(False))) for c in NEEDED_VALUES),
        ("malformed_email", "error", "email", "e-mail address is malformed", is_csv & has("email") & ~F.trim(cell("email")).rlike(P.EMAIL_WHOLE)),
        ("malformed_phone_number", "error", "phone", "phone number has other characters", is_csv & has("phone") & ~F.trim(cell("phone")).rlike(P.PHONE_CHARACTERS)),
        ("malformed_phone_number", "error", "phone", "phone number has fewer than 7 digits", is_csv & has("phone") & F.trim(cell("phone")).rlike(P.PHONE_CHARACTERS) & (digits < 7)),
    ]


def issues() -> Column:
    """The issues of a raw record."""
    return F.array_compact(F.array(*(_issue(*check) for check in _checks())))


def with_issues(raw: DataFrame) -> DataFrame:
    return schema.require(raw, NEEDS, ValidationError).withColumn("issues", issues())


def issue_rows(raw: DataFrame) -> DataFrame:
    """One row per issue."""
    return with_issues(raw).select("record_id", F.inline("issues"))


def report(raw: DataFrame) -> DataFrame:
    """One row: counts of records, of issues by severity, and of records without a fatal issue."""
    marked = with_issues(raw)
    count = lambda s: F.coalesce(F.sum(F.size(F.filter("issues", lambda i: i.severity == s))), F.lit(0)).cast("long")
    counts = marked.agg(F.count("*").alias("total_records"), *(count(s).alias(f"{s}_count") for s in SEVERITIES), F.count_if(~has_fatal()).alias("valid_records"))
    return counts.withColumn("has_errors", F.col("error_count") > 0).withColumn("has_fatals", F.col("fatal_count") > 0)


def has_fatal() -> Column:
    return F.exists("issues", lambda i: i.severity == "fatal")


def drop_fatal(raw: DataFrame) -> DataFrame:
    """Records without a fatal issue. A predicate on the row itself, so no join."""
    schema.require(raw, NEEDS, ValidationError)
    fatal = reduce(lambda a, b: a | b, (F.coalesce(when, F.lit(False)) for _, severity, _, _, when in _checks() if severity == "fatal"))
    return raw.filter(~fatal)


def validate_configuration(config: Mapping) -> list[dict]:
    """Issues of a configuration's output_fields. What isn't a list of non-blank names is an error right away."""
    if not isinstance(config, Mapping):
        raise ConfigurationError("the configuration is no mapping")
    fields = config.get("output_fields")
    if fields is None:
        return [{"code": "config_missing_output_fields", "severity": "error", "field": "output_fields", "message": "output_fields is missing"}]
    if not isinstance(fields, list) or any(not isinstance(f, str) or not f.strip() for f in fields):
        raise ConfigurationError("output_fields must be a list of non-blank names")
    return [] if fields else [{"code": "config_empty_output_fields", "severity": "error", "field": "output_fields", "message": "output_fields is empty"}]
