"""Registry of runnable queries over the given tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Added before rounding on both sides: a value that lies exactly between two rounded ones
# (a mean over 32 rows, say) must not depend on the order in which an engine adds.
_NUDGE = 1e-9


def query(name: str, sql: str | None = None):
    """Register a query; without sql only its rows can be checked from outside."""

    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@dataclass(frozen=True)
class Shape:
    """Output columns by kind, written the same way on both sides."""

    whole: str = ""
    real: str = ""
    text: str = ""
    digits: int = 6

    def of(self, df: DataFrame) -> DataFrame:
        return df.select(
            *[F.col(c).cast("bigint").alias(c) for c in self.whole.split()],
            *[F.round(F.col(c).cast("double") + _NUDGE, self.digits).alias(c) for c in self.real.split()],
            *[F.col(c).cast("string").alias(c) for c in self.text.split()],
        )

    @property
    def sql(self) -> str:
        parts = [f"CAST({c} AS BIGINT) AS {c}" for c in self.whole.split()]
        parts += [f"round(CAST({c} AS DOUBLE) + {_NUDGE}, {self.digits}) AS {c}" for c in self.real.split()]
        parts += [f"CAST({c} AS VARCHAR) AS {c}" for c in self.text.split()]
        return ", ".join(parts)


def load() -> None:
    """Import every query module once."""
    from foretide.plans import (  # noqa: F401
        checks_cleaning,
        checks_documents,
        checks_features,
        checks_keyed,
        checks_pricing,
        checks_tables,
    )
    from foretide.plans import checks_models  # noqa: F401, I001

    for name in ("slate_scores", "calibrated_model", "model_variants", "feature_family_ablation"):
        QUERIES[name] = QUERIES.pop(name)  # hundreds of boosting rounds each: last in order
