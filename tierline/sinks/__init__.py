"""Everything that writes."""
