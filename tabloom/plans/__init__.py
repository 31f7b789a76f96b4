"""Chaining operators into one lazy Spark plan."""
