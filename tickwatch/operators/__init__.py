"""DataFrame operators: decode, measure, grade, route, sync, serve."""
