"""pitchside sources."""
