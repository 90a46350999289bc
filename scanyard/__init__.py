"""Document-intake analytics on Spark DataFrames.

``sources``    reads and writes: role tables, Parquet, CSV, text, JDBC
``functions``  Column -> Column building blocks (text, dates, decoding, predicates)
``operators``  DataFrame -> DataFrame building blocks (joins, aggregates, sets, order)
``plans``      shared extracts and the report pipelines built from them
"""
