"""ledgermill: turn messages and documents into a clean ledger with Spark DataFrames."""
