"""daycast.plans."""
