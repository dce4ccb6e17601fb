"""Writers: table replace, schema evolution, back-fill, clustered layout."""
