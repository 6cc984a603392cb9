"""The temporal frame: a DataFrame whose rows carry a lifetime [vs, ve) and optional group keys."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from .operators.aggregate import AggregateOps
from .operators.joins import JoinOps
from .operators.lifetime import LifetimeOps
from .operators.patterns import PatternOps
from .operators.placement import PlacementOps
from .operators.project import ProjectOps
from .operators.quality import QualityOps
from .operators.sets import SetOps
from .plans.slices import Cuts
from .sources.egress import EgressOps
from .sources.scratch import settle


@dataclass(frozen=True)
class Props:
    """Declared facts that allow a cheaper plan; `frame.violations()` checks them."""

    duration: int | None = None
    hop: int | None = None
    offset: int = 0
    open_ended: bool = False

    @property
    def tumbling(self) -> bool:
        return self.hop is not None and self.hop == self.duration

    def but(self, **changes) -> Props:
        return replace(self, **changes)


class TemporalFrame(
    ProjectOps,
    LifetimeOps,
    JoinOps,
    AggregateOps,
    PatternOps,
    SetOps,
    PlacementOps,
    QualityOps,
    EgressOps,
):
    def __init__(
        self, df: DataFrame, keys=(), props: Props | None = None, cuts: Cuts | None = None, wide=False
    ):
        for c in ("vs", "ve"):
            if c not in df.columns:
                raise ValueError(f"a temporal frame needs the lifetime column {c!r}")
        self.df = df
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        missing = [k for k in self.keys if k not in df.columns]
        if missing:
            raise ValueError(f"key columns not found: {missing}")
        self.props = props or Props()
        self._cuts = cuts
        self._wide = wide
        self._settled = None

    @property
    def payload(self) -> list[str]:
        return [c for c in self.df.columns if c not in ("vs", "ve", *self.keys)]

    @property
    def cuts(self) -> Cuts:
        if self._cuts is None:
            self._cuts = Cuts(self.df, self.keys, "vs")
        return self._cuts

    def _with(self, df: DataFrame, keys=None, props=None, cuts=None, wide=None) -> TemporalFrame:
        """A derived frame. It inherits the cuts, unless times moved away from the source's times."""
        return TemporalFrame(
            df,
            self.keys if keys is None else keys,
            Props() if props is None else props,
            cuts or self.cuts,
            self._wide if wide is None else wide,
        )

    def settle(self) -> TemporalFrame:
        """Write the rows to a table in the shared folder and go on from there.

        The operators that shuffle read their input several times. They settle it themselves when it comes out
        of another such operator, so that a chain of operators costs the sum, not the product, of its parts.
        """
        if self._settled is None:
            self._settled = self._with(settle(self.df), props=self.props, wide=False)
        return self._settled

    def _ready(self) -> TemporalFrame:
        return self.settle() if self._wide else self

    def __repr__(self) -> str:
        return f"TemporalFrame(keys={self.keys}, payload={self.payload}, props={self.props})"
