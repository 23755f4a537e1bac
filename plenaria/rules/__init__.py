"""Word lists, label tables and ordered classifier rules."""
