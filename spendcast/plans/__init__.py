"""Composed jobs: features, training, scenarios."""
