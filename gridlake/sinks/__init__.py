"""Writers for each layer."""
