"""Column functions: parsing, URLs and text."""
