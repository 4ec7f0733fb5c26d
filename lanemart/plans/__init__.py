"""Domain stages of the mart. A stage maps source frames to one frame with one row per key."""
