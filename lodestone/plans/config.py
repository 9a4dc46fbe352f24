"""Pipeline configuration: JSON into checked dataclasses, with one-level overrides."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

from lodestone.errors import ConfigurationError
from lodestone.operators.projection import checked


@dataclass(frozen=True)
class InputPaths:
    recruiter_csv_path: str
    resume_directory: str


@dataclass(frozen=True)
class OutputPaths:
    output_json_path: str


@dataclass(frozen=True)
class ProjectionPath:
    config_path: str


@dataclass(frozen=True)
class LogSettings:
    level: str = "INFO"


@dataclass(frozen=True)
class Processing:
    """batch_size is read for compatibility; partitions take its place."""

    batch_size: int = 100


@dataclass(frozen=True)
class SourceFlags:
    """Other flags are allowed; no reader answers to them."""

    enable_recruiter_csv: bool = True
    enable_resumes: bool = True


@dataclass(frozen=True)
class OutputRules:
    required_fields: list[str] = field(default_factory=lambda: ["candidate_id"])
    allow_unknown_fields: bool = True
    pretty: bool = True


@dataclass(frozen=True)
class PipelineConfig:
    input: InputPaths
    output: OutputPaths
    projection: ProjectionPath
    logging: LogSettings = LogSettings()
    processing: Processing = Processing()
    sources: SourceFlags = SourceFlags()
    output_validation: OutputRules = OutputRules()
    root: str = "."

    def resolve(self, path: str) -> str:
        """The path itself if it is absolute or a URI, else below root."""
        return path if "://" in path or Path(path).is_absolute() else str(Path(self.root) / path)


_PARTS = {"input": InputPaths, "output": OutputPaths, "projection": ProjectionPath, "logging": LogSettings, "processing": Processing, "sources": SourceFlags, "output_validation": OutputRules}


def build_config(values: Mapping[str, Any], root: str = ".") -> PipelineConfig:
    if not isinstance(values, Mapping):
        raise ConfigurationError("the configuration must be a JSON object")
    if unknown := sorted(set(values) - set(_PARTS)):
        raise ConfigurationError(f"unknown sections: {', '.join(unknown)}")
    parts: dict[str, Any] = {}
    for name, given in values.items():
        if name == "sources" and isinstance(given, Mapping):
            given = {k: v for k, v in given.items() if k in {f.name for f in fields(SourceFlags)}}
        try:
            parts[name] = _PARTS[name](**checked(_PARTS[name], given, ConfigurationError))
        except TypeError as e:
            raise ConfigurationError(f"section {name}: {e}") from e
    if missing := [n for n in ("input", "output", "projection") if n not in parts]:
        raise ConfigurationError(f"sections are missing: {', '.join(missing)}")
    config = PipelineConfig(**parts, root=root)
    if config.processing.batch_size < 1:
        raise ConfigurationError("processing.batch_size must be 1 at least")
    return config


def load_json(path: str | Path) -> Any:
    try:
        return json.loads(Path(path).read_text("utf-8"))
    except OSError as e:
        raise ConfigurationError(f"can't read {path}: {e}") from e
    except json.JSONDecodeError as e:
        raise ConfigurationError(f"{path} is no JSON: {e}") from e


def load_config(path: str | Path, overrides: Mapping[str, Mapping] | None = None, root: str | None = None) -> tuple[PipelineConfig, dict]:
    """The configuration, each section updated by its overrides, and the projection configuration it names."""
    values = load_json(path)
    if not isinstance(values, dict):
        raise ConfigurationError("the configuration must be a JSON object")
    for section, given in (overrides or {}).items():
        values[section] = {**values.get(section, {}), **given}
    config = build_config(values, root or ".")
    projection = load_json(config.resolve(config.projection.config_path))
    if not isinstance(projection, dict):
        raise ConfigurationError("the projection configuration must be a JSON object")
    return config, projection
