"""Cohort analytics as composable PySpark DataFrame operators."""
