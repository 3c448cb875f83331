"""Gold metrics and the Bronze-to-Silver run."""
