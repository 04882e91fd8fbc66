"""Nested JSON snapshots to a relational star, as Spark DataFrame plans."""
