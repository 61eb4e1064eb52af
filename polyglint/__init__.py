"""polyglint: Spark-native analytics for multilingual, engagement-bearing content tables."""

__version__ = "0.1.0"
