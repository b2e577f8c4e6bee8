"""Column expressions: text, numbers, dates, geography, fuzzy scores."""
