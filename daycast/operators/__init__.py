"""daycast.operators."""
