"""PySpark-native analytics for chimeric sequencing reads."""
