"""Spark operators for daily trade files: raw -> typed -> OHLCV tables."""
