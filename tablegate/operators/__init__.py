"""DataFrame operators: schema, typed access, lines, limits, statistics, observation."""
