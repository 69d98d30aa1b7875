"""Composed datasets: cleaned tables, indicators, dashboards and the full run."""
