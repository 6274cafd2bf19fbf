"""Composed plans: the feature, weather and scoring flows, the query registry and its SQL oracles."""
