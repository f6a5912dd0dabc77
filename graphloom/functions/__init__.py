"""Scalar functions over columns: identifiers, CIGAR strings, GTF attributes and sequences."""
