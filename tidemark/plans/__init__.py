"""Composite models: staging, marts, the end-to-end run and the query catalog."""
