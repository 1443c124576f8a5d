"""Composed plans: test-data bindings, check presets, pipeline stages, reports."""
