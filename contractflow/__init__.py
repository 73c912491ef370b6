"""Contract-checked ingestion and table history on Spark."""

from .contract import Column, Contract
from .errors import CommitConflict, ContractError, DataRejected, QualityFailed
from .operators.ledger import Policy
from .plans.publication import publish
from .plans.snapshots import SnapshotFlow
from .plans.tables import TableFlow
from .plans.graph import Input, View, ViewGraph
from .plans.terms import SourceTerms
from .plans.views import materialize, python_view, sql_view
from .sources.datasets import Dataset, read_dataset
from .streaming.feeds import AppendFlow, ChangeFlow

__all__ = [
    "AppendFlow",
    "ChangeFlow",
    "Column",
    "CommitConflict",
    "Contract",
    "ContractError",
    "DataRejected",
    "Dataset",
    "Input",
    "Policy",
    "QualityFailed",
    "SnapshotFlow",
    "SourceTerms",
    "TableFlow",
    "View",
    "ViewGraph",
    "materialize",
    "publish",
    "python_view",
    "read_dataset",
    "sql_view",
]
