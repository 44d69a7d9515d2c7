"""Tessera: a DataFrame-first engine for building and analysing code corpora on Spark."""

__version__ = "0.1.0"
