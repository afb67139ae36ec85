"""Plans: the models, reports and jobs composed from operators."""
