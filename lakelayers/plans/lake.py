"""Where the layers lie and how strict the gates are."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T

from lakelayers.operators.quality import DEFAULT_THRESHOLD, RULES, Rule, allow, limit_rows
from lakelayers.session import MAX_WIDTH


@dataclass(frozen=True)
class Lake:
    """Paths and choices of one dataset's layers.

    ``bronze_gate`` is ``report`` or ``raise``. ``bronze_mode`` ``overwrite`` replaces a date that is ingested
    again, ``append`` keeps every delivery and takes a delivered file in once, however often a run is repeated. ``rejects`` ``keep`` takes rows
    that do not fit the header as Spark parses them, short ones filled up and long ones cut; ``divert`` puts them into
    a reject table instead. ``scope`` ``partition`` replaces only the dates of the run in the
    later layers, ``table`` leaves nothing but the dates of the last run. ``order_by`` names the columns that tell
    which row of an order is the newest, e.g. a time that the source writes; without it the ingestion time does.
    A step that fails for another reason than its data is repeated ``retries`` times, ``retry_wait`` seconds apart.
    ``max_rows`` replaces the upper bound of the row-count rule, ``widest`` bounds the shuffle width of a run.
    """

    root: str
    raw: str
    dataset: str = "orders"
    layout: str = "{raw}/{dataset}/{dt}.csv"
    raw_format: str = "csv"
    raw_schema: T.StructType | None = None
    infer: bool = False
    fmt: str = "parquet"
    threshold: float = DEFAULT_THRESHOLD
    bronze_gate: str = "report"
    bronze_mode: str = "overwrite"
    scope: str = "partition"
    extra_allowed: Mapping[str, Sequence[str]] = field(default_factory=dict)
    max_rows: int | None = None
    order_by: Sequence[str] = ()
    widest: int = MAX_WIDTH
    rejects: str = "keep"
    retries: int = 1
    retry_wait: float = 0.0

    def __post_init__(self) -> None:
        for name, allowed in (("bronze_mode", ("overwrite", "append")), ("rejects", ("keep", "divert"))):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}, not {getattr(self, name)!r}")
        if self.rejects == "divert" and self.fmt != "parquet":
            raise ValueError("rejected rows can be diverted from Parquet layers only")

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/{self.dataset}"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/{self.dataset}"

    def staging(self, run_id: str) -> str:
        """Where a run keeps rows between check and publication; a run has its own folder."""
        return f"{self.root}/staging/{self.dataset}/{run_id.replace(':', '-')}"

    @property
    def rejected(self) -> str:
        """Where diverted rows go."""
        return f"{self.root}/rejects/{self.dataset}"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold/daily_order_summary"

    def control(self, table: str) -> str:
        return f"{self.root}/control/{table}"

    @property
    def raw_layout(self) -> str:
        """Path of a date's source, with ``{dt}`` in the date's place."""
        return self.layout.replace("{raw}", self.raw).replace("{dataset}", self.dataset)

    def raw_path(self, dt: str) -> str:
        return self.raw_layout.replace("{dt}", dt)

    @property
    def rules(self) -> tuple[Rule, ...]:
        rules = allow(RULES.get(self.dataset, ()), self.extra_allowed)
        return rules if self.max_rows is None else limit_rows(rules, self.max_rows)
