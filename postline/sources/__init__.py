"""Readers and writers of the payload, the zones and the warehouse tables."""
