"""Training-data operators: ten corpus operators, their registered queries and oracles.

Nothing outside this package and ``corpus_pipeline.py`` imports it.
"""
