"""Column expressions: stable draws, date keys, exact money."""
