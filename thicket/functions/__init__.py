"""Column functions of occurrence data."""
