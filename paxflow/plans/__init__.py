"""End-to-end plans and the registered query set."""
