"""DataFrame -> DataFrame operators; they run no action."""
