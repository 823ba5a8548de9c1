"""Reading and writing the stored layers and the control tables."""
