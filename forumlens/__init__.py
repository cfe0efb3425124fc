"""Community-signal analytics as composable PySpark DataFrame operators."""
