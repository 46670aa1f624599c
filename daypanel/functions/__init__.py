"""Column expressions and one-pass projections."""
