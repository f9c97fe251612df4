"""Writing batches, upserts, staging tables and audit rows."""
