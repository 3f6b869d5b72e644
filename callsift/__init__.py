"""Spark-native conversation analytics: transcripts in, traceable metrics out."""
