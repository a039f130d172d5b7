"""All registered queries; importing the package fills the registry."""

from larkspar.catalog import (  # noqa: F401
    aggregates,
    joins,
    learning,
    missing,
    projections,
    scalars,
    sinks,
    sorting,
    sources,
    streams,
    windows,
)
from larkspar.catalog.registry import JOBS, SQL, runnable

__all__ = ["JOBS", "SQL", "runnable"]
