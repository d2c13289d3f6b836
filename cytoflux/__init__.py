"""cytoflux: single-cell multi-omics preprocessing as declarative Spark jobs."""
