"""Jobs over file paths and the registered queries over the driver tables."""
