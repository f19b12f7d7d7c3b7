"""supportlens: customer-support text analytics expressed as Spark jobs.

Sub-packages:

* ``functions``  -- Column -> Column expressions (JVM-side, codegen'd).
* ``operators``  -- DataFrame -> DataFrame jobs (joins, windows, aggregates,
  Arrow-batched model calls).
* ``sources``    -- table readers/writers, declared schemas, derived views.
* ``plans``      -- end-to-end compositions of the operators.
* ``streaming``  -- the same column operators over a Structured Streaming source.

Nothing in this package performs I/O at import time.
"""

__all__ = ["functions", "operators", "sources", "plans", "streaming"]
