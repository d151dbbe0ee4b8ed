"""Operators of a training-data pipeline: scoring, filtering, deduplication, packing, archives.

Nothing else in the library imports this subpackage. ``queries`` registers its queries
and ``oracle`` holds their DuckDB SQL.
"""
