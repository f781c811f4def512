"""Training-data operators: quality, deduplication, tokenisation, packing and toxicity.

Nothing else in the package imports this subpackage. Operators take and return
DataFrames; ``queries`` applies each to its whole table.
"""
