"""Incremental runs of the stateless part of the pipeline."""
