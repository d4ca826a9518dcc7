"""Report files and layer tables."""
