"""The whole consolidation as one lazy plan, and its stages by name."""

from __future__ import annotations

import logging
import time
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators import confidence, identity, mapping, normalize, output, projection, provenance, survivorship, validation
from lodestone.operators.extract_structured import extract_structured
from lodestone.operators.extract_text import extract_text
from lodestone.plans.config import PipelineConfig
from lodestone.sources.recruiter_csv import empty_records, read_recruiter_csv
from lodestone.sources.resumes import read_resumes
from lodestone.sources.tables import union_sources

LOG = logging.getLogger(__name__)


def extract(raw: DataFrame) -> DataFrame:
    """Fields of structured records and of documents, routed by tag."""
    structured = extract_structured(raw.filter(F.array_contains("tags", "recruiter")))
    return structured.unionByName(extract_text(raw.filter(F.array_contains("tags", "resume"))))


def normalized(raw: DataFrame, strict_dates: bool = True) -> DataFrame:
    """Valid records, extracted, mapped and normalized: narrow all the way, so no shuffle."""
    return raw.transform(validation.drop_fatal).transform(extract).transform(mapping.to_canonical).transform(normalize.normalize, strict_dates)


def golden(records: DataFrame) -> DataFrame:
    """Golden records of normalized ones."""
    return records.transform(identity.resolve).transform(survivorship.merge).transform(provenance.backfill).transform(confidence.assess)


def load_sources(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    """Records of the enabled sources, CSV first."""
    sources = []
    if config.sources.enable_recruiter_csv and config.input.recruiter_csv_path:
        sources.append(read_recruiter_csv(spark, config.resolve(config.input.recruiter_csv_path)))
    if config.sources.enable_resumes and config.input.resume_directory:
        sources.append(read_resumes(spark, config.resolve(config.input.resume_directory)))
    return union_sources(*(sources or [empty_records(spark)]))


@dataclass(frozen=True)
class Summary:
    """What a run did."""

    records: int
    golden_records: int
    seconds: float
    output_path: str


def run(spark: SparkSession, config: PipelineConfig, projection_config: Mapping | str) -> Summary:
    """Read, consolidate, project, validate and write. Records are counted by a scan of their own, golden records as they are written."""
    began = time.perf_counter()
    raw = load_sources(spark, config)
    masters = golden(normalized(raw))
    projected = projection.project(masters, projection_config)
    contract = output.parse_output({"required_fields": config.output_validation.required_fields, "allow_unknown_fields": config.output_validation.allow_unknown_fields, "pretty": config.output_validation.pretty, "projection": dict(projection_config) if isinstance(projection_config, Mapping) else None})
    valid = output.validate(projected, contract)
    path = config.resolve(config.output.output_json_path)
    made = output.write_json_array(valid, path, contract.pretty)
    out = Summary(raw.count(), made, time.perf_counter() - began, path)
    LOG.info("%d records gave %d golden records in %.1f s: %s", out.records, out.golden_records, out.seconds, path)
    return out
