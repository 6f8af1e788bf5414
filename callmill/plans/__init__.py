"""Jobs and queries composed from the operators."""
