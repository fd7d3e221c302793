"""Writers of the raw zones, and table definitions."""
