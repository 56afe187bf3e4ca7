"""Analysis operators: each takes DataFrames and returns DataFrames that carry their evidence."""
