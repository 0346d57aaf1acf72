"""Table operators: every one takes a DataFrame and returns a DataFrame."""
