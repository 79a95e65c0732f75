"""Column helpers (JVM-side expressions) and the numpy polygon kernel used inside Arrow batches."""
