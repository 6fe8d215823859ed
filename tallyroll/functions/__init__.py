"""Column expressions: text, dates, rule ladders and full-time-equivalent arithmetic."""
