"""End-to-end jobs, derived tables and the registered queries."""
