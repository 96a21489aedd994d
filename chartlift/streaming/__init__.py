"""The change log as a stream."""
