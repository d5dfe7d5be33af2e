"""DataFrame operators.  Every function is lazy and returns a DataFrame."""
