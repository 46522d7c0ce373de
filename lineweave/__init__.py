"""Measurements along linear networks, and the relational operators behind them, as Spark DataFrame plans."""
