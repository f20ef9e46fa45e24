"""Reading and writing files and staged tables."""
