"""Column expressions; all of them stay inside Catalyst (no Python per row)."""
