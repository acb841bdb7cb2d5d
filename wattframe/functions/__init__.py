"""Column functions: rounding, calendar, bands and distance."""
