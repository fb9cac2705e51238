"""Job specs and the runs they describe."""
