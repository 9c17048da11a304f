"""Reading parts, forecast runs and outputs; writing outputs."""
