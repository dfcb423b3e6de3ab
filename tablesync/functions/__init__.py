"""Column expressions: temporal decoding, masking, keyword tests, type mapping."""
