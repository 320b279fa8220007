"""Part of siftloom."""
