"""Table-level operators: cleaning, profiling, constraints, sampling, reconciliation."""
