"""Relational operators of the pipeline (all DataFrame in, DataFrame out)."""
