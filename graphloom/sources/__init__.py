"""Readers and writers of FASTA, BED, GTF, SAM/BAM and graph packages, and tables in the shared folder."""
