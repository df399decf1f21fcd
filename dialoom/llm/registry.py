"""Queries of the corpus operators and the SQL that checks them."""

from dialoom.llm import codes, counts, language, mixing, neardup, negatives, packing, quality, secrets, shards, toxicity, vectors

MODULES = (codes, counts, language, mixing, neardup, negatives, packing, quality, secrets, shards, toxicity, vectors)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
SQL = {name: sql for m in MODULES for name, sql in m.SQL.items()}
