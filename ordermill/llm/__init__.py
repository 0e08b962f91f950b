"""Operators of a training-data pipeline; each module holds one of them.

Nothing is imported here: Python workers load only the module they need.
"""
