"""Training-data operators: deduplication, filtering, extraction, formatting and tokenising of text corpora.

Nothing outside this folder imports it (``__spark_entry__`` looks for it and goes without it where it is missing).
"""
