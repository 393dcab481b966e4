"""Table helpers: every function takes and returns DataFrames."""
