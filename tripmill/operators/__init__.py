"""DataFrame to DataFrame operators; columns, keys and rules are arguments."""
