"""Search-revenue last-touch attribution on Spark DataFrames."""

from .errors import (
    AttributionError,
    CheckpointError,
    DuplicateRunError,
    InputSchemaError,
    OutputWriteError,
    ParsingError,
    StorageIOError,
)
from .options import AttributionOptions
from .plans.attribution import AttributionResult, attribute, attribute_files

__all__ = [
    "AttributionError", "CheckpointError", "DuplicateRunError", "InputSchemaError",
    "OutputWriteError", "ParsingError", "StorageIOError", "AttributionOptions",
    "AttributionResult", "attribute", "attribute_files",
]
