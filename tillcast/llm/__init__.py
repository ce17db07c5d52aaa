"""Operators for preparing training corpora, one module each.

Every operator takes DataFrames and returns DataFrames; ``queries``
registers them over the synthetic tables.  Nothing outside this folder
imports it.
"""
