"""DataFrame operators: joins, aggregates, windows and shaping."""
