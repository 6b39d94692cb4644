"""Column functions: native expressions over strings, tokens and arrays."""
