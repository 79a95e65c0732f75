"""vigie — geo-compliance analytics on Spark DataFrames.

Layout:
  sources/    table readers, fixture views, literal seed tables, sinks
  functions/  Column helpers (text, dates, projections) and the numpy polygon kernel
  plans/      cell index, size-checked broadcast, spatial candidate joins
  operators/  user-level operators: spatial (S*), cohort (C*), workflow (W*), loads (P*), quality (Q*)
  streaming/  incremental (micro-batch) form of the detection load
"""

__all__ = ["registry"]
