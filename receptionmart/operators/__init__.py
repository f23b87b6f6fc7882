"""DataFrame operators that jobs are composed of."""
