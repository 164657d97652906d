"""Dataset flows, quality reports and the registered queries."""
