"""Readers, writers, manifests and release bookkeeping."""
