"""tierflow: a bronze -> silver -> gold medallion pipeline written as
plain PySpark DataFrame functions (DataFrame in, DataFrame out)."""

__version__ = "0.1.0"
