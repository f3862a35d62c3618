"""Scans of annotation files, prepared splits, catalogues and run records, and the sinks that write them."""
