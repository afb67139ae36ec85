"""A product catalogue derived from the star-schema test tables, and its SQL oracle."""
