"""Daily stock-market analytics written as PySpark DataFrame functions.

``functions``  column expressions and window specs
``sources``    table schemas, TSV landing, partitioned warehouse tables
``operators``  the analyses: DataFrames and parameters in, one lazy DataFrame out
``plans``      write jobs that fill derived tables, and the query registry
``streaming``  incremental landing of daily drops
"""
