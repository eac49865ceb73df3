"""Column -> Column functions; all native expressions."""
