"""Plans: named assessment queries, their SQL oracles, analyzer views and
the multi-workspace run."""
