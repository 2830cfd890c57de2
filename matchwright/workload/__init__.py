"""The operators put to work on the benchmark tables, with their SQL oracles."""
