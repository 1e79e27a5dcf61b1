"""tickwise: market-tick analytics expressed as Spark DataFrame plans.

Layout
------
functions/  column builders (rounding, time, indicator expressions)
sources/    readers, decoders, adapters from the driver tables, sinks
operators/  DataFrame -> DataFrame operators (enrichment, views, quality)
streaming/  Structured Streaming jobs and the stateful enrichment
plans/      named query catalogue used by ``__spark_entry__`` and the bench
"""

from tickwise.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
