"""DataFrame-to-DataFrame steps and aggregate measures."""
