"""Daily time-series preparation, features, forecasting and evaluation as Spark DataFrame operations."""

from daygrain.series import Series

__all__ = ["Series"]
