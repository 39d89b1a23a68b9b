"""Feature tables, models and batch jobs built from the operators."""
