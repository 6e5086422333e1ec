"""Operators for large training-data pipelines. Nothing else in docmill imports this subpackage."""
