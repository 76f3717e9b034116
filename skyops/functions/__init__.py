"""Column functions: plain ``Column -> Column`` building blocks."""
