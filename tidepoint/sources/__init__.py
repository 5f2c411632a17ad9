"""Where points come from: scans, saved query responses and discovery."""
