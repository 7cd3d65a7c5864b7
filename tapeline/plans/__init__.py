"""Star schema, full run and the registered queries."""
