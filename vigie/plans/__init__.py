"""Physical-plan helpers: size-checked broadcast, distributed surrogate ids, the spatial cell index and candidate joins."""
