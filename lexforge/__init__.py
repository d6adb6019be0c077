"""A Spark-native engine for filing sentiment: text to sections, scores, rankings and reports."""
