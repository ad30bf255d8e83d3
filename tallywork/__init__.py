"""Corpus and table analytics written for PySpark DataFrames."""
