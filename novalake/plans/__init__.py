"""The bronze and silver tables as DataFrame functions, and their refresh."""
