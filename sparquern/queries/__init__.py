"""Queries over the tables, each with its oracle; importing them registers them."""

from . import conversations, documents, plans, quality, retrieval, stories, texts  # noqa: F401
