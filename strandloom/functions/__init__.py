"""Part of strandloom."""
