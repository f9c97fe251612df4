"""Reading landing files, lake layers and fixed tables."""
