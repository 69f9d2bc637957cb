"""Operators of a large-scale training-data pipeline (see README, "Training-data operators").

Nothing else in the library imports this subpackage.
"""
