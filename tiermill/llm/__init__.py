"""Operators of a training-data pipeline: dedup, decontamination, packing, classifiers.

Nothing else in the library imports this subpackage.
"""
