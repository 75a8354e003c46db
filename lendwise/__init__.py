"""lendwise: Spark-native preparation and analytics for consumer-loan tables.

Layout
------
functions/  pure ``Column`` builders (features, text, exact money sums)
operators/  DataFrame -> DataFrame steps (profiling, imputation, outliers,
            encoding, ordered/windowed history, joins)
sources/    readers and sinks (files, params store, lookup store, JDBC, HTML)
plans/      composite jobs: analytic queries (DataFrame + SQL), the
            fit/transform cleaning pipeline, reports
streaming/  the same transform over Structured Streaming
"""

from lendwise.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
