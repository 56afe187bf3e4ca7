"""Column expressions and small distributed building blocks the operators share."""
