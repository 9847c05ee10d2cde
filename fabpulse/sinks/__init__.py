"""Writers. All of them can be run again with the same input."""
