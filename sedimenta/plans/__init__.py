"""Job specifications and the layer steps that run them."""

from sedimenta.plans.partitioned import PartitionedStore
from sedimenta.plans.run import run_lake, report_frame
from sedimenta.plans.spec import GoldSpec, LakeLayout, StepResult, StepSpec, TableSpec
from sedimenta.plans.sql import run_sql, temp_views
from sedimenta.plans.steps import apply_step, run_bronze, run_gold, run_silver
from sedimenta.plans.stores import CatalogStore, SnapshotStore

__all__ = [
    "CatalogStore",
    "GoldSpec",
    "LakeLayout",
    "PartitionedStore",
    "SnapshotStore",
    "StepResult",
    "StepSpec",
    "TableSpec",
    "apply_step",
    "report_frame",
    "run_bronze",
    "run_gold",
    "run_lake",
    "run_silver",
    "run_sql",
    "temp_views",
]
