"""Report plans over the star schema."""
