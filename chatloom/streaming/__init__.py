"""The conversion expressions on a file stream."""
