"""Generic DataFrame operators: keys, merges, change feeds, histories, quality rules."""
