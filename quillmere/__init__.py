"""Schema-first, Spark-native pipeline from publisher files to a validated graph."""
