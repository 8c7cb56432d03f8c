"""Reading and writing tables and landing files."""
