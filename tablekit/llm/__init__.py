"""Training-data pipeline operators: toxicity, near and substring dedup,
decontamination, SentencePiece, quality rules, language ID, sharding, chat
formatting, URL filters, phrase mining, secret scans and the source audit.

Each operator is a function of DataFrames in a module of its own; the thin
registered queries are in ``queries``.  Nothing else in the library imports
this package.
"""
