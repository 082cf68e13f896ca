"""Column functions: text and identity keys, dates and ages, domain values."""
