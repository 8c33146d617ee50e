"""File sources, schema hints, rescued values, landing checks and versioned tables."""
