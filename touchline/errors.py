"""Error taxonomy: one base class, one subclass per failure mode."""


class AttributionError(Exception):
    """Base class for every error raised by this package."""


class InputSchemaError(AttributionError):
    """Required columns are missing, or the input has no header row."""


class ParsingError(AttributionError):
    """A single record could not be parsed (strict callers only)."""


class CheckpointError(AttributionError):
    """Streaming checkpoint location is unusable."""


class OutputWriteError(AttributionError):
    """A result, manifest or ledger write failed or was refused."""


class StorageIOError(AttributionError):
    """Reading or listing input storage failed."""


class DuplicateRunError(AttributionError):
    """Every candidate input was already recorded in the intake ledger."""
