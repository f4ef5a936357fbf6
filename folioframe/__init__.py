"""folioframe: a PySpark-native engine for laid-out documents and text corpora."""
