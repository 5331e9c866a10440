"""Operators of a training-data pipeline: decontamination, secret scans, language ID, LM scoring,
HTML extraction, token files, SimHash near-dedup, WARC derivatives, nearest neighbours, packing.

Nothing else in the library imports this subpackage; ``queries.py`` registers its queries.
"""
