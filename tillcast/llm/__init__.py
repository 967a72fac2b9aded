"""Training-data operators: tokenisation, duplicates, filters, extraction, language, search.

Nothing outside this package imports it. ``queries.QUERIES`` and
``queries.ORACLE`` hold the registered queries and their SQL.
"""
