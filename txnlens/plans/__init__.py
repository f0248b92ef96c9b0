"""Jobs: operators composed from raw tables to results."""
