"""Column expressions, predicates and calendar rules."""
