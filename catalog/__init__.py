"""Queries over the driver tables: every operator on whole tables, with its oracle in SQL."""
