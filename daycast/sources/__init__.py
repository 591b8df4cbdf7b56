"""daycast.sources."""
