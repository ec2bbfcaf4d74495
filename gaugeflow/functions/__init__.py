"""Column expressions and the helpers that keep joins and orderings skew-safe."""
