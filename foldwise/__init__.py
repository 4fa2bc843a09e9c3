"""foldwise: fold-aware tabular learning plans on Spark.

Feature operators, fold statistics, cross-validation metrics, blending,
prediction contracts, run ledgers and submission reconciliation, all
expressed as DataFrame / SQL / pyspark.ml / Structured Streaming plans.
"""

from foldwise.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
