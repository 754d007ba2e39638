"""Training-data operators: tokenising, cleaning, deduplication and mixing of text corpora.

Nothing outside this subpackage imports it.
"""
