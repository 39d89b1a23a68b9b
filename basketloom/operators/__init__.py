"""Table operators: checks, imputation, aggregation, ordered windows."""
