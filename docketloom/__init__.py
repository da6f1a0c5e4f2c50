"""docketloom: a PySpark-native document-to-table engine."""
