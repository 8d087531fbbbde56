"""Everything that starts a query: runs, sinks, delivery, state."""
