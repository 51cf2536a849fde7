"""Training-data operators: filtering, deduplication, tokens, archives, mixing and packing.

Nothing else in the library imports this subpackage; ``queries`` holds the registered
queries and their SQL.
"""
