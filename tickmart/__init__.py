"""Market-tick analytics on Spark: cleaning, rollups, alerts, sentiment and serving queries."""

__version__ = "0.1.0"
