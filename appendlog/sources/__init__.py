"""File selection, file metadata, option resolution and the test corpus writer."""
