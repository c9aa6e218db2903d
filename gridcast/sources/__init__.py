"""Readers: raw tables, seeds, relational tables, forecast indexes and listings."""
