"""Jobs, derived inputs and the registered queries."""
