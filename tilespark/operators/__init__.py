"""DataFrame operators on slides, tiles, masks, features, scores and run records."""
