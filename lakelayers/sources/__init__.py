"""Raw file scans, layer tables and the shared working folder."""
