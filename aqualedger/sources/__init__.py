"""Source tables: schemas, landing (read + conform), stand-ins, sinks."""
