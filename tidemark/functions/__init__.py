"""Column-level building blocks: geometry, hexagon cells, time, display."""
