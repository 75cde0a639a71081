"""Operators for preparing training data: each module holds one operator, ``suite`` its registered query."""
