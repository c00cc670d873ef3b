"""Price history and tick processing as PySpark DataFrame operators."""
