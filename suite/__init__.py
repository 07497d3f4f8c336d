"""Every operator as a query over the given tables, with the SQL it must match."""

from suite.base import REGISTRY, oracle_sql, queries  # noqa: F401
from suite import aggregates, bins, compares, features, joins, scores, series, sources, streams, targets  # noqa: F401
