"""DataFrame -> DataFrame operators (joins, aggregations, bands, stay rules)."""
