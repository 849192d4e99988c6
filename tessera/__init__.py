"""tessera: a Spark-native feature-engineering and statistical-learning library.

DataFrame in, DataFrame out. Every operator is a composition of Spark SQL
expressions, windows, joins and one-pass aggregates; the few places that need
per-partition NumPy use ``mapInPandas`` over Spark-partitioned data.
"""

from tessera.session import get_session, checkpoint_dir, load_tables

__all__ = ["get_session", "checkpoint_dir", "load_tables"]
