"""DataFrame-to-DataFrame operators on listings."""
