"""DataFrame-to-DataFrame operators; none of them knows a file path."""
