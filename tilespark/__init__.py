"""Slide analytics and tabular pipelines, expressed as DataFrame-to-DataFrame functions."""
