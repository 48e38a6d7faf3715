"""Reading, writing and session settings."""
