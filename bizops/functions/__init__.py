"""Column expressions: rounding rules, zero guards and label rules."""
