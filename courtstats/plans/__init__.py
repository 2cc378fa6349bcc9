"""The steps from stored pages to the feature table."""
