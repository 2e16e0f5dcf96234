"""The row-local steps on a stream of note files."""
