"""A Spark-native engine for quarter-hourly marginal-cost series."""
