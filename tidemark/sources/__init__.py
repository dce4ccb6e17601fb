"""Readers: ping CSV (plain, zstd, zip), feature files, file listings, link pages."""
