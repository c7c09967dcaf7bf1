"""Operators for large-scale training-data pipelines.

Nothing else in the package imports this subpackage.  Each module holds one
operator with a general interface; ``queries`` holds the registered
``opN_<name>`` queries over the driver's tables and their oracle SQL.
"""
