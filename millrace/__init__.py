"""Composable PySpark operators for activity, warehouse, trade and rate analytics."""
