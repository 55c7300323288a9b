"""Operators: cleaning, dimensions, facts, gold aggregates, scores, recommendations, candidates, features, exploration, ALS."""
