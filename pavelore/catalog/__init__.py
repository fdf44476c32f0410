"""Registered queries: each runs an operator on the given tables, most with a SQL twin."""

from . import (  # noqa: F401  (registration)
    aggregates, files, geography, jobs, joins, models, scalars, streams,
)
from .base import ORACLES, QUERIES  # noqa: F401
