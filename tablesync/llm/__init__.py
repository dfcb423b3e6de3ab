"""Operators of a training-data pipeline over large tables of documents."""
