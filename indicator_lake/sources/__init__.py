"""Source catalog, snapshot loading, audit rows and table layout."""
