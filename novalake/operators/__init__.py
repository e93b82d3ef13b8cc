"""DataFrame -> DataFrame operators the table plans are composed of."""
