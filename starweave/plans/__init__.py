"""Plans: star-schema builds and the registered queries over the driver tables."""
