"""Plans: conform layer, stars, analyses and the semantic view, composed from the operators."""
