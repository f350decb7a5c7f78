"""DataFrame-in, DataFrame-out operators and fitted models."""
