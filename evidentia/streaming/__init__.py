"""The capture log as a stream."""
