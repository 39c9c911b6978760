"""DataFrame -> DataFrame operators; thresholds are arguments, nothing is collected."""
