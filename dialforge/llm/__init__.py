"""Operators of a training-data pipeline, each a ``DataFrame -> DataFrame`` job.

Nothing outside this folder (and ``corpus_pipeline.py`` at the top) imports it.
"""
