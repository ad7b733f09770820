"""Writers and layout."""
