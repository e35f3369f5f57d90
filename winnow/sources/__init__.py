"""sources package."""
