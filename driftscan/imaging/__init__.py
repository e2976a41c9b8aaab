"""NumPy kernels over single images; they run inside Arrow-batched functions."""
