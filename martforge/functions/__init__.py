"""Column expressions: cast rules and date helpers (built-in functions only)."""
