"""pitchside plans."""
