"""Current-state, wide customer tables from versioned hub-and-satellite sources."""
