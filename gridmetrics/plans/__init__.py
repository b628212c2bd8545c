"""The jobs: landing zone -> silver -> gate -> gold -> marts."""
