"""Operators for preparing training data: archives, token files, quality and
language models, decontamination, deduplication, nearest neighbours, mixing
and chat formatting. Nothing else in the library imports this subpackage."""
