"""orderlake: a Spark-native daily retail order lakehouse.

Landing gate, daily enrichment, key-based gold merge with additive schema
evolution, data tests, reconciliation audit and partition-pruned marts, all
as DataFrame / Spark SQL jobs.
"""

__version__ = "0.1.0"
