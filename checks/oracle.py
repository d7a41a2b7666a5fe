"""Query name -> DuckDB SQL."""

from __future__ import annotations

from checks import ingestion, layers, models, reports  # noqa: F401  (importing fills the book)
from checks.book import BOOK, compose

ORACLE: dict[str, str] = {name: f"select * from {name}" for name in BOOK if name.startswith(("silver_", "gold_"))}
ORACLE.update(reports.CHECKS)
ORACLE.update(models.CHECKS)
ORACLE.update(ingestion.CHECKS)


def oracle_sql() -> dict[str, str]:
    return {name: compose(sql) for name, sql in ORACLE.items()}
