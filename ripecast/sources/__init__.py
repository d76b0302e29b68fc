"""Readers and writers: CSV deliveries, typed tables, and the retail tables derived from the sample star schema."""
