"""Training-data operators: token files, packing, archives, privacy, quality and near duplicates.

Nothing else in the library imports this package. Each operator is a module with
a general ``DataFrame -> DataFrame`` interface; :mod:`partflow.llm.queries` holds
the thin registered queries over the given tables.
"""
