"""Column-level building blocks: names, text, dates, value conversion."""
