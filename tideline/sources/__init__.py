"""Readers.  Each returns a lazy DataFrame; only headers are looked at early."""
