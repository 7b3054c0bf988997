"""The registered queries: operators wired to the benchmark tables, and their SQL oracles."""
