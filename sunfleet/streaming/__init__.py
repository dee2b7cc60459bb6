"""The daily extract as an incremental file job."""
