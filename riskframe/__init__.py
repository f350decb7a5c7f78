"""riskframe: Spark jobs for tabular risk profiling, feature engineering and
imbalanced binary classification.

Every operator takes and returns Spark DataFrames (or fitted models whose
``transform`` is a lazy projection). Nothing whole passes through the driver:
fitted state is a handful of scalars per column, and every data-sized step is
a Spark aggregation, join, window or Arrow-batched task.
"""

__version__ = "0.1.0"
