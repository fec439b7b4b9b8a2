"""The landing zone as a stream."""
