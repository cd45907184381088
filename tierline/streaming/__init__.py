"""File streams in place of file-time watermarks."""
