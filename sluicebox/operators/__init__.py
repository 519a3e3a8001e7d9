"""Table operators: measure, decide, rewrite."""
