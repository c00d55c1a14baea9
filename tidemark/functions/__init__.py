"""Column functions: byte access, positions, temporals and fixed name tables."""
