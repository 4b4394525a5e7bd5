"""Report plans and the registered queries."""
