"""Failures of the stages."""


class IngestError(Exception):
    """Any failure of ingestion."""


class FetchError(IngestError):
    """A raw file can't be had."""


class ParseError(IngestError):
    """A raw file can't be read."""


class EmptySourceError(IngestError):
    """A source gave no record."""


class UnknownSourceError(IngestError):
    """No adapter of that name."""


class ValidateError(Exception):
    """Any failure of validation."""


class StagingInputError(ValidateError):
    """Staged records or their manifest are missing."""


class SchemaConfigError(ValidateError):
    """A row schema can't be used."""


class ValidationFailedError(ValidateError):
    """A record was rejected in a run that stops at the first."""


class EmptyBronzeError(ValidateError):
    """No record was accepted."""


class BronzeInputError(Exception):
    """Accepted records are missing."""


class RowMaterializationError(Exception):
    """A record can't be turned into fragments."""
