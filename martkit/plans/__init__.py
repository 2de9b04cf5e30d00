"""Jobs: the operators put together, from zone to zone."""
