"""Training-data operators: deduplication, decontamination, tokenisation, scoring.

Nothing else in the library imports this subpackage.
"""
