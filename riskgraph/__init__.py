"""riskgraph: fraud analytics on a payment graph, expressed as Spark DataFrame jobs.

Node and edge tables are plain DataFrames; graph patterns are joins, graph
algorithms are iterative DataFrame jobs whose lineage is cut with reliable
checkpoints, and every report is a declarative aggregate that Catalyst plans.
"""

from riskgraph.session import ensure_checkpoint_dir, get_session

__all__ = ["get_session", "ensure_checkpoint_dir"]
