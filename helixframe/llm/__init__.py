"""Operators for large-scale training-data pipelines.

Nothing else in :mod:`helixframe` imports this subpackage.
"""
