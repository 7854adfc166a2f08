"""Column functions: text, numbers, URLs, page markup and JSON coercion."""
