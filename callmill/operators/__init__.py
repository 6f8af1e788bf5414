"""DataFrame-to-DataFrame steps; no I/O and no actions."""
