"""Whole queries and pipelines, made of operators."""
