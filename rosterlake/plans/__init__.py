"""Plans: queries, reports and pipelines made of the operators."""
