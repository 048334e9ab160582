"""Building blocks: cleaning, keys, star schema, loads, checks and profiles."""
