"""Design matrix, models, metrics and scoring of the next-day category."""
