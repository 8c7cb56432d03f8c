"""Keeping features and model up to date as files arrive."""
