"""Column-level functions (strings, dates, geometry, arrays, tail probabilities)."""
