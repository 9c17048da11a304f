"""Column expressions: missing values, time, bits, packing, window weights."""
