"""Readers and writers of run caches, atlases, bitmaps and frame strips."""
