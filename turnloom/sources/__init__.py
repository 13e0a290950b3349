"""Readers and writers of audio, transcripts and manifests."""
