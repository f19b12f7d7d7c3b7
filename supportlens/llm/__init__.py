"""Operators of a training-data pipeline (token counts, personal data,
decontamination, quality, licences, near-duplicates, WARC, secrets, mixing).

Nothing outside this subpackage imports it; the registered queries and their
SQL live in ``queries.py``.
"""
