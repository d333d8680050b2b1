"""DataFrame operators: every function here maps a DataFrame to a DataFrame."""
