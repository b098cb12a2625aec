"""Row cleaning, checks and detectors."""
