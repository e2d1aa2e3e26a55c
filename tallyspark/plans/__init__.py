"""Named queries over the given tables, one module per group of operators."""

from . import (  # noqa: F401
    aggregation, clv, forecast, graph, ingestion, joins, layout, news, profiling, projection, risk,
    scalars, streams, tabular, timeseries, topics,
)
from .registry import ORACLES, QUERIES  # noqa: F401
