"""Building-energy analytics as PySpark DataFrame functions."""
