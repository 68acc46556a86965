"""Sources: landed store pages, feeds, sites, history and the driver tables."""
