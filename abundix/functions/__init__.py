"""Column expressions: feature ids, references, alignments, statistics, sequences."""
