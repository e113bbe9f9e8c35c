"""The same cleaning over files that keep arriving."""
