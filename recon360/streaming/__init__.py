"""New source files as a stream."""
