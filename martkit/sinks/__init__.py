"""Writers of the zones and the table catalog."""
