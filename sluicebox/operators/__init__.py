"""DataFrame -> DataFrame operators. Each takes any table plus column names."""
