"""Example layers derived from the driver's tables, the registered queries over them, and their SQL counterparts."""
