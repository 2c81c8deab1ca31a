"""A Spark-native engine for document-grid extraction: geometry, numbering, text assembly, run accounting."""
