"""vigil package."""
