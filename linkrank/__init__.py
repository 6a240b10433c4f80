"""Link ranking on Spark DataFrames."""

from linkrank.files import adjacency_to_ranked, check_ranked_files, edges_to_adjacency, rank_files, write_ranked
from linkrank.plans.graph import Graph, prepare, prepare_records
from linkrank.plans.iterate import RankResult, rank, resume, runs
from linkrank.plans.workspace import Workspace

__all__ = [
    "Graph",
    "RankResult",
    "Workspace",
    "adjacency_to_ranked",
    "check_ranked_files",
    "edges_to_adjacency",
    "prepare",
    "prepare_records",
    "rank",
    "rank_files",
    "resume",
    "runs",
    "write_ranked",
]
