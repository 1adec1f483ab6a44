"""Set-at-a-time operators: each takes DataFrames and returns one, with no action inside."""
