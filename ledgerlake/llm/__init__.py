"""Operators of a training-data pipeline (dedup, tokenisation, packing, filters).

One module per operator; ``registry`` names the queries.  Nothing outside this
subpackage imports it.
"""
