"""Column expressions and the few Arrow-batched functions that need Python."""
