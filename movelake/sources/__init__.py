"""Feed readers: landed payloads -> movement tables, and the stand-in data."""
