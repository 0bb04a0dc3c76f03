"""DataFrame operators: alignment, cleaning, duplicates, keys, history, reports."""
