"""Layered (bronze / silver / gold) data work on Spark DataFrames.

Every operator is a function from DataFrames to a DataFrame built from Spark's own
expressions, so it composes with ``DataFrame.transform`` and runs alike on batch tables
and, where the semantics allow it, on streams.
"""
