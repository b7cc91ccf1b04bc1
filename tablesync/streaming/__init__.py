"""The copy, the cleaning and the ledger as Structured Streaming jobs."""
