"""Retail feature engine on Spark: clean events, features, streams, online rows."""
