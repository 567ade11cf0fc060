"""Table specifications and the batch jobs built from them."""
