"""The batch operators applied to file streams.

The reference has no streaming operators. What carries over is its
incremental use: new invoice files arrive and per-part totals must follow.
Every operator in ``partflow.operators`` that is a plain projection, filter
or aggregation also runs on a streaming DataFrame; this package only adds the
source and sink wiring (schema-declared file source, checkpoint in the shared
folder, ``availableNow`` trigger).
"""

from partflow.streaming.incremental import part_totals_stream, run_available_now, stream_files

__all__ = ["stream_files", "part_totals_stream", "run_available_now"]
