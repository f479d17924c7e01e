"""Review analytics expressed as PySpark DataFrame operators."""
