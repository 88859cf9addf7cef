"""Card-payment risk analytics as PySpark DataFrame operators."""
