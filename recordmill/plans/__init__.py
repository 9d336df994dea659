"""Planning of chunks from object metadata."""
