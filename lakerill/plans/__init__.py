"""Ready queries: the sales analytics, and the suite that runs every operator on the benchmark tables."""
