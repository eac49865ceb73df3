"""The driver's tables seen as bank tables, the registered queries and their SQL counterparts."""
