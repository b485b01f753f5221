"""Operators for building training corpora: near duplicates, token files, filters, mixing, decontamination."""
