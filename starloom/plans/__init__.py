"""Publish jobs and the catalogue of models, relationships and measures."""
