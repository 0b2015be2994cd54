"""quillgraph: knowledge-graph analytics and training-data preparation on Apache Spark."""
