"""Readers of landed listings, taxonomies, archives, history and datasets."""
