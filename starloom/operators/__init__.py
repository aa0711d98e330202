"""DataFrame in, DataFrame out: cleaning, upserts, key lookups, the star view, rankings."""
