"""DataFrame operators: checks, roll-ups, mapping, history, levels."""
