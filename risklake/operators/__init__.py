"""DataFrame -> DataFrame operators: quality, features, scoring, decisions, roll-ups, training."""
