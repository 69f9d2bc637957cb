"""riskframe: a Spark-native credit-risk feature, scoring and evaluation engine."""

__version__ = "0.1.0"
