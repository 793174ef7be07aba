"""Writers of the stored tables."""
