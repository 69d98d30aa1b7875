"""Queries over the driver's tables that prove each operator, with their SQL counterparts."""
