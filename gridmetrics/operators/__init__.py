"""DataFrame operators: parse, merge, calendar, star, marts, measures, checks, planning."""
