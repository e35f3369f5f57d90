"""queries package."""
