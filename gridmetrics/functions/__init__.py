"""Column expressions: JSON typing, ISO dates, in-record grain."""
