"""Scans: driver tables, landing folders of CSV/Excel files, stage listings."""
