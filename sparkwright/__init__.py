"""sparkwright: a Spark-native toolkit for typed loading, cleaning, profiling,
attribute-ratio feature selection, encoding, splits, clustering-based and
per-category detectors, ensembles, evaluation, document-style updates and a
Structured Streaming text job.

Every operator is a function ``DataFrame -> DataFrame`` (or a Spark ML stage)
built from native expressions; nothing iterates over data rows on the driver.
"""

from sparkwright.session import get_spark, shared_path

__all__ = ["get_spark", "shared_path"]
__version__ = "0.1.0"
