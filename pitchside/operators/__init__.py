"""pitchside operators."""
