"""Column functions: text, dates, hashes and validators, all built from Spark's own."""
