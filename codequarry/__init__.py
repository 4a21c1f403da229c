"""codequarry: curation of source-code datasets and program-graph analytics on PySpark."""
