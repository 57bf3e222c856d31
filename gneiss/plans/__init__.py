"""Named analytic plans: weather layers, run observability, cost, quality and PII."""
