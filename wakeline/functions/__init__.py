"""Column expressions: time, geometry, ids and vessel codes."""
