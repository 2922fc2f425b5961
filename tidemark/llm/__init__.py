"""Operators for preparing training text: cleaning, deduplication, counting, packing, sharding.

Nothing else in the library imports this package. Operators that run Python inside tasks need
the package on the executors (`--py-files`, or an installed wheel), as any PySpark job does.
"""
