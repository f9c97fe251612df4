"""Bronze, silver, staging, dimensions, facts and reports."""
