"""Operators: stats, sets, pairs, similarity, neighbors, predict, evaluate,
recommend. Each takes and returns DataFrames."""
