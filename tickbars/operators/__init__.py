"""DataFrame -> DataFrame operators; the same bodies serve batch and stream."""
