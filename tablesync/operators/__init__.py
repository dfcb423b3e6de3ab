"""Operators over DataFrames: catalog, typing, routing, keyed merge, back-fill, audit."""
