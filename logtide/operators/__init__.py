"""Operators on sharded record streams: DataFrame in, DataFrame out."""
