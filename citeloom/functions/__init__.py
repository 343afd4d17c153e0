"""Column expressions: identifier normalization, JSON truth values, HTML text, metadata, dates."""
