"""Spark-native builder of yearly filing release tables.

Every operator is a ``DataFrame -> DataFrame`` function built from native
Spark SQL expressions, joins, windows and aggregates.  Package layout:

* ``sources``    - readers for extracts, lookups, prior releases, fixes
* ``functions``  - column expressions (amount parsing, codes, money rules)
* ``operators``  - table operators (schema, filters, joins, de-dup, rules,
                   flags, corrections, review jobs)
* ``plans``      - end-to-end release build and the registered queries
"""

__all__ = ["session"]
