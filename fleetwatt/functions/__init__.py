"""Column expressions: times, numbers and labels."""
