"""Jobs and the registered queries."""
