"""Writers: message topics, files, dimension tables."""
