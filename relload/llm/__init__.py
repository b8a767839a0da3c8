"""Operations of a training-data pipeline: search, deduplication, filtering, mixing, sharding.

Nothing else in the library imports this subpackage.  ``queries`` holds the registered
queries and their DuckDB SQL; every other module holds one operator (or a helper that
operators share) with its own interface.
"""
