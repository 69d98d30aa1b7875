"""DataFrame operators shared by the plans."""
