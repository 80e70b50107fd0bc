"""End-to-end jobs, registered views and the query registry."""
