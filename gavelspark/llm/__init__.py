"""Corpus operators: entity linkage, tokenization, leakage and quality.  Nothing outside imports this."""
