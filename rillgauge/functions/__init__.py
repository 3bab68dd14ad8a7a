"""Column expressions: cleaning, naming, dates and grid geometry."""
