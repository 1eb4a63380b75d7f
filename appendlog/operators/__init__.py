"""DataFrame operators: parallel byte-range line reads and offset state jobs."""
