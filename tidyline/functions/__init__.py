"""Column -> Column building blocks (character classes, text measures, draws)."""
