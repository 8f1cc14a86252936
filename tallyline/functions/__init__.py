"""Column functions: normalisation of headers, keys and values; numbers; dates; references."""
