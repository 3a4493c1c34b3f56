"""Operators for preparing large text corpora.

Thirteen operators, one module each, and ``registry`` with their queries.  Every
operator takes DataFrames and returns DataFrames; nothing else in the
library imports this subpackage.
"""
