"""End-to-end loads composed from operators, and the registered query keys."""
