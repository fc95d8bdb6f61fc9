"""Operators of a training-data pipeline (see README, "Training-data operators").

Nothing else in the package imports this subpackage; ``queries.py`` registers
its queries and ``/corpus_pipeline.py`` chains five of the operators.
"""
