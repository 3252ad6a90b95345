"""Column expressions: row-level columns, predicates, measures and labels."""
