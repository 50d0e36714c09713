"""Operators for a training-data pipeline over large text corpora.

One module per operator; ``queries`` registers them for the driver and
``corpus_pipeline.py`` at the repository top chains five of them.  Nothing
outside this subpackage imports it.
"""
