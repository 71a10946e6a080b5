"""Training-data operators: dedup, decontamination, extraction, tokenising, archiving.

Nothing outside this package imports it.
"""
