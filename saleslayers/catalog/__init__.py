"""Every query by name, with its SQL statement of the same result."""
