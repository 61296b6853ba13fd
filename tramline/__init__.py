"""tramline: mobility, sensor and text analytics as plain PySpark DataFrame functions."""
