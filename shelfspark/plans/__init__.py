"""Plans: the lazy medallion table graph, the DAG runner, registered queries and their SQL oracles."""
