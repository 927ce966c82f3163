"""Order events: one set of transforms for batch and stream."""
