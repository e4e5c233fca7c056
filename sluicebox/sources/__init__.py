"""Reading landed files and writing result files."""
