"""Multi-step jobs built from the operators, and the registry of runnable queries."""
