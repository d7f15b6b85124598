"""Bindings of the driver tables to claims entities and the registered plans."""
