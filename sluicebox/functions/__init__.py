"""Column expressions: Column in, Column out, no actions."""
