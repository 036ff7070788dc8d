"""Readers, writers and the GeoPackage data source."""
