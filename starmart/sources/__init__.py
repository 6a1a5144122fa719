"""Raw files, landing area, code dictionary and warehouse tables."""
