"""Operators of a training-data pipeline, one module per operator.

Nothing else in the library imports this subpackage; ``queries.py`` holds the
registered queries and ``corpus_pipeline.py`` at the repository top the pipeline.
"""
