"""Migration jobs: each takes staged DataFrames and returns the rows of its target tables.

Concepts are named by references ``CIEL:code`` or ``LOCAL:code``; LOCAL stands for the site's own dictionary.
References become ids when observations are resolved, by a join with the dictionary the caller supplies.
"""
