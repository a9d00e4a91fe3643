"""noticeworks: a PySpark-native analytics engine for public-procurement notices."""
