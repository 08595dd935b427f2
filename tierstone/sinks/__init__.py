"""Writers: layer tables in the catalog, and CSV hand-offs."""
