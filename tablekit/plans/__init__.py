"""What to do with which table: specs, the table run, the wide models."""

from tablekit.plans.models import build_models, inventory_model, rental_model
from tablekit.plans.pipeline import RunReport, TableResult, run_pipeline
from tablekit.plans.specs import RENTAL_STORE_SPECS, TableSpec, clean

__all__ = [
    "RENTAL_STORE_SPECS",
    "RunReport",
    "TableResult",
    "TableSpec",
    "build_models",
    "clean",
    "inventory_model",
    "rental_model",
    "run_pipeline",
]
