"""Readers and writers of the feeds the engine knows."""
