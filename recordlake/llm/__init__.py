"""Operators of a training-data pipeline. Nothing else in recordlake imports this subpackage."""
