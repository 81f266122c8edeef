"""Column expressions: no UDFs, everything stays inside code generation."""
