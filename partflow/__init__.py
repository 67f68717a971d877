"""partflow: manufacturing / ERP analytics as Spark DataFrame operators.

Every public operator is a plain ``DataFrame -> DataFrame`` function built from
Spark's DataFrame / SQL API. Sub-packages:

* ``sources``    entity scans, filters, key lookups, paging, JSON pages, sinks
* ``functions``  column-level helpers (null-safe merge, parsing, patterns)
* ``operators``  joins, cleaning, report tables, text, bill-of-material ops
* ``plans``      composite flows and the registry of runnable queries
* ``streaming``  the same operators over file streams
"""

from partflow.session import get_session, checkpoint_dir, materialize

__all__ = ["get_session", "checkpoint_dir", "materialize"]
