"""Loading driven by arriving files."""
