"""Query plans: registered test-data queries, their SQL oracles, fixture flows."""
