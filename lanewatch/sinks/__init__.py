"""Writers: delimited tables, topics, feature files."""
