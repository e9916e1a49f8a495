"""Training-data operators: dedup, toxicity, chat formatting, page text,
language-model scores, packing, token files, decontamination, fingerprints.

Nothing else in the library imports this subpackage. Every operator takes
DataFrames and column names and returns a DataFrame; the digest columns of
the registered queries are derived in ``queries``.
"""
