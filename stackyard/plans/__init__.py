"""Named queries over the provided tables and their SQL oracles."""
