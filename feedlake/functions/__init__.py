"""Column helpers built only from pyspark.sql.functions."""
