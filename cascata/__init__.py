"""cascata — stream/table analytics expressed as Spark DataFrame plans.

Every operator here builds a lazy DataFrame (or a Structured Streaming
query) and leaves planning, shuffling, spilling and recovery to Spark.

Sub-packages
------------
functions   column expressions (tokenise, decode, render, route)
operators   DataFrame operators (running totals, sharding, counting, ...)
sources     readers for tables, text directories and message topics
sinks       JDBC changelog, keyed upsert store, rolling delimited files
streaming   Structured Streaming jobs built on the operators
plans       the named query catalog and its SQL oracles
cli         command-line jobs (``spark-submit cascata/cli.py <job>``)
"""

from cascata.session import checkpoint_root, get_session

__all__ = ["get_session", "checkpoint_root"]
