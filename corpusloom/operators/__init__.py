"""Relational and document-level operators."""
