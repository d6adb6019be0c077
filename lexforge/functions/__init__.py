"""Column functions over text, names and times."""
