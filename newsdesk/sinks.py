"""Writers for outside consumers (tables live in ``newsdesk.store``)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from newsdesk.operators.catalog import export_rows


def export_pubs_csv(pubs: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header ``ID, Pub Name, Homepage, Added`` (MM/dd/yyyy). Written
    in parallel, one part per task; ``single_file`` only for small exports."""
    rows = export_rows(pubs)
    if single_file:
        rows = rows.coalesce(1)
    rows.write.mode("overwrite").option("header", True).csv(path)
