"""Retrieval and agent-memory analytics on Spark DataFrames.

``functions``  column-level building blocks (no joins, no actions)
``operators``  DataFrame-to-DataFrame operators
``sources``    readers, writers and object listings
``plans``      compositions of operators and the registered queries
``streaming``  the same operators fed by Structured Streaming
"""
