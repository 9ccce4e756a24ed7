"""ledgerline: payment-ledger analytics as PySpark DataFrame operators.

Sub-packages: ``sources`` (ledger views, file sources and sinks), ``functions`` (column
helpers), ``operators`` (cleaning, features, validation, scaling, aggregates, windows, star
schema, plus the distributed median and ranking), ``plans`` (stage compositions, the five
analytical queries, the query registry and its DuckDB oracle SQL) and ``streaming`` (event
enrichment on Structured Streaming).
"""

__version__ = "0.1.0"
