"""End-to-end plans and the query catalogue over the driver tables."""
