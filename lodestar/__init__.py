"""lodestar: a PySpark engine for periodically collected listing records.

Layers (each a lazy DataFrame -> DataFrame function):
  sources/    paged source, CSV snapshots read by header, unions, stamps
  functions/  column expressions (safe casts, repaired JSON, geo, text, stats)
  operators/  typed projection, fact flags, spatial comps, weekly series,
              reshaping, latest snapshot, anomaly bands, presentation frames
  streaming/  high-water-mark appends, batch and Structured Streaming forms
  plans/      stand-in inputs built from the test tables and whole chains
"""

__version__ = "0.1.0"
