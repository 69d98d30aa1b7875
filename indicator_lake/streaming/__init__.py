"""Indicator events: contract, routing and two-sink streaming."""
