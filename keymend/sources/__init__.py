"""Reading, materialising and naming tables."""
