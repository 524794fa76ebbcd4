"""eventide — product-event analytics on Spark.

Operators are plain functions from DataFrames to a DataFrame, grouped by
concern: ``operators.model`` (ingest, dedupe, fact, dimensions),
``operators.quality`` (reconciliation and data-quality checks),
``operators.funnel`` (onboarding funnel and behaviour), ``operators.reports``,
``operators.governance``, ``operators.docs`` and ``streaming.stream``. The
skew-safe building blocks live in ``functions.skew`` and ``functions.ranking``;
``plans.registry`` names every query over the given tables and
``plans.oracle`` holds its DuckDB SQL twin.
"""

__version__ = "0.1.0"
