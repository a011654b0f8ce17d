"""Vehicle and packet data derived from the given tables, the registered
queries over them, and the SQL that checks each query."""
