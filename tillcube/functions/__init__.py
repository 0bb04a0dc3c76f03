"""Column expressions: typing, measures and flags, calendar parts, guarded ratios."""
