"""DataFrame operators: cleaning, duplicates, summary, quality rules, run analytics."""
