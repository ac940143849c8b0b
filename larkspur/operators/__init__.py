"""Relational, text, recommendation, vector and model operators."""
