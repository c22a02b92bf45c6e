"""Operators of a training-data pipeline on document, page and label tables. Nothing outside this folder imports it."""
