"""Operators on alignments, graphs, clusters, transcripts and names: functions from DataFrames to DataFrames."""
