"""Joins that Spark's own operators do not cover."""

from .skew import deal, frequent_keys, hot_keys, spread_join

__all__ = ["deal", "frequent_keys", "hot_keys", "spread_join"]
