"""DataFrame -> DataFrame operators; columns, domains and thresholds are arguments."""
