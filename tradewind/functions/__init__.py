"""Column expressions: no joins, no shuffles, everything stays in generated code."""
