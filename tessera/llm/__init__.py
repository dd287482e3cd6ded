"""Training-data pipeline operators: one module per operator, plus the registry of their queries."""
