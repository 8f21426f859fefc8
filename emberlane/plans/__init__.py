"""The query catalogue: what the operators compute on the driver's tables, and the same in SQL."""
