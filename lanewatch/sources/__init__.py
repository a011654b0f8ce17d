"""Readers: delimited tables, vehicle XML, topics, packet captures."""
