"""Where things lie under the one root folder of a lake."""

from __future__ import annotations


class Layout:
    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def raw(self, run_id: str, dataset: str) -> str:
        return f"{self.root}/raw/run_id={run_id}/{dataset}"

    def flagged(self, run_id: str) -> str:
        return f"{self.root}/staged/run_id={run_id}"

    def quarantine(self, dataset: str, run_id: str | None = None) -> str:
        base = f"{self.root}/quarantine/{dataset}"
        return base if run_id is None else f"{base}/run_id={run_id}"

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"

    def report(self, run_id: str) -> str:
        return f"{self.reports}/quality_report_{run_id}"

    def lineage(self, run_id: str, step: str) -> str:
        return f"{self.root}/lineage/run_id={run_id}/step={step}"

    def lake(self, table: str) -> str:
        return f"{self.root}/processed/{table}"

    def manifest(self, run_id: str) -> str:
        return f"{self.root}/processed_manifests/transform_manifest_{run_id}"

    def warehouse(self, table: str) -> str:
        return f"{self.root}/warehouse/{table}"
