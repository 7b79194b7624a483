"""Jobs put together from operators and sources."""
