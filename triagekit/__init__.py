"""triagekit: case-risk analytics on Spark.

Profiling, association tests, feature building, grouped cross-validation and
scored-table analysis (threshold, cost, segment, fairness, calibration,
stability, monitoring), each written as a DataFrame -> DataFrame function or a
``pyspark.ml`` stage.
"""

__version__ = "0.1.0"
