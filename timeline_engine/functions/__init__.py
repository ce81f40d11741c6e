"""Column functions and bitmap kernels."""
