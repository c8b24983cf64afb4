"""Loomcat: a Spark-native engine for curated document catalogs.

sources     loaders and sinks
functions   column expressions
operators   relational operators over DataFrames
plans       whole jobs: the manifest, and the operators over the benchmark tables
streaming   the append-only event log as a stream
llm         operators for training-data pipelines (optional)
"""
