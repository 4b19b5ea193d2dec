"""Composed jobs: transfer (R1-R4), delivery (R5), enrichment.

``catalog`` holds the registered queries and ``oracle`` their SQL.
"""

from docflow.plans.delivery import deliver_json_batches, run_delivery
from docflow.plans.enrichment import entity_rows, run_enrichment
from docflow.plans.transfer import TransferResult, run_transfer, tag_rows, transfer_delta

__all__ = ["TransferResult", "deliver_json_batches", "entity_rows", "run_delivery", "run_enrichment",
           "run_transfer", "tag_rows", "transfer_delta"]
