"""Plans built from the operators: the daily batch, the named queries and their SQL oracle."""
