"""Models fitted by few scans of one staged table, many at a time."""
