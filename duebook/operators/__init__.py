"""DataFrame-in, DataFrame-out operators. Each docstring states the grain it returns."""
