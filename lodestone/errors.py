"""Exceptions. Every stage has its own, below one base."""


class ConsolidationError(Exception):
    """Base of all."""


class ConfigurationError(ConsolidationError):
    """The configuration can't be read or is invalid."""


class SourceError(ConsolidationError):
    """A source can't be read."""


class CsvSourceError(SourceError):
    """A CSV source is malformed."""


class ResumeSourceError(SourceError):
    """A résumé source is malformed."""


class ValidationError(ConsolidationError):
    """Records can't be validated."""


class ExtractionError(ConsolidationError):
    """Fields can't be extracted."""


class MappingError(ConsolidationError):
    """Records can't be mapped."""


class NormalizationError(ConsolidationError):
    """Records can't be normalized."""


class IdentityError(ConsolidationError):
    """Identities can't be resolved."""


class SurvivorshipError(ConsolidationError):
    """Groups can't be merged."""


class ProvenanceError(ConsolidationError):
    """Provenance can't be tracked."""


class ConfidenceError(ConsolidationError):
    """Confidence can't be scored."""


class ProjectionError(ConsolidationError):
    """A projection is invalid."""


class OutputError(ConsolidationError):
    """The output breaks its contract."""


class SinkError(ConsolidationError):
    """The output can't be written."""
