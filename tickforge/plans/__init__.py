"""Plans: the registered queries, their SQL oracles and the stage runner."""
