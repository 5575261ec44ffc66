"""Training-data operators: thirteen corpus operators and their registered queries.

Nothing outside this subpackage imports it. ``queries.QUERIES`` and
``queries.ORACLE_SQL`` hold what ``__spark_entry__.py`` adds.
"""
