"""Readers: native files, and the route-network view of the driver tables."""
