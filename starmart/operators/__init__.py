"""DataFrame -> DataFrame operators: extract, dimensions, facts, lookups."""
