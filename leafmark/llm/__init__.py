"""Training-data operators: classifiers, rules, extraction, sharding, tokenising, dedup, licences, mixing.

Nothing outside this subpackage imports it.  Queries are in :mod:`leafmark.llm.queries`.
"""
