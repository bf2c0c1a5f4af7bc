"""One query per operator over the driver tables, each with an independent SQL oracle."""

from checks import (  # noqa: F401  (imports register the queries)
    auditing,
    columns,
    deletes,
    dimensions,
    files,
    keyed_writes,
    loads,
    quality,
    selection,
)
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
