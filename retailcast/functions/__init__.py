"""Column-level functions: calendar parts, holidays, cyclical encodings, demand factors."""
