"""The named queries of the package, by subject."""

from .registry import QUERIES, Query  # noqa: F401
from . import contracts, graphs, joblogs, streams, timeseries  # noqa: F401
