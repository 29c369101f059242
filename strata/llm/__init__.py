"""Operators of a training-data pipeline at corpus scale.

Every operator takes and returns Spark DataFrames.  Nothing else in the
library imports this subpackage; its queries are registered through
``strata.llm.registry``.
"""
