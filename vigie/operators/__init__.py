"""User-level operators (one per key of the survey's work list)."""
