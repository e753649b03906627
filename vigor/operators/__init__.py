"""DataFrame -> DataFrame operators (relational, sinks, quality, ML)."""
