"""Operators of a training-data pipeline.

``registry`` has one query per operator; nothing else in the library imports this package.
"""
