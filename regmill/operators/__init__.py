"""DataFrame-to-DataFrame steps."""
