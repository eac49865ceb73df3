"""Layered batch analytics for retail-banking-shaped tables, written as Spark DataFrame transformations."""
