"""Training-data operators: language ID, near-dedup, PII, secrets, packing, token files, scoring.

Nothing outside this subpackage imports it; ``queries.py`` holds the
registered queries and ``SQL`` their DuckDB twins.
"""
