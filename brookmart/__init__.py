"""Real-time shop warehouse on Spark: routing, facts, windowed metrics and reports as DataFrame functions."""

__version__ = "0.1.0"
