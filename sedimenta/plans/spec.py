"""What to run, as plain data."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from sedimenta.operators.merge import KeyColumn
from sedimenta.sources.landing import LandingFormat

Transform = Callable[[DataFrame], DataFrame] | str
GoldBuild = Callable[[Mapping[str, DataFrame]], DataFrame] | str


@dataclass(frozen=True)
class LakeLayout:
    """Root of each layer. A table lives at ``<root>/<NAME IN UPPER CASE>``."""

    transient: str
    bronze: str
    silver: str
    gold: str

    def path(self, layer: str, table: str) -> str:
        return f"{getattr(self, layer).rstrip('/')}/{table.upper()}"

    def archive(self, table: str) -> str:
        return f"{self.transient.rstrip('/')}/TRANSIENTFILES/{table.upper()}"


@dataclass(frozen=True)
class StepSpec:
    """One transform from a layer to the next.

    ``transform``      a function of the input frame, or SQL text over the view ``view``.
    ``key``            the output has one row per key, and is upserted on it.
    ``merge_key``      upsert on these columns instead, to keep only the newest version of
                       a record whose content changed.
    ``order_by``       which row survives among equal keys.
    ``distinct``       the transform already returns one row per key, so no dedupe follows; a
                       save fails if it does not.
    ``args``           values of the named parameters (``:day``) of SQL text.
    ``unchecked``      leave that check out: for keys that are made from distinct rows.
    ``one_to_one``     the transform maps each input row to one output row and carries the
                       key along. If the input holds each key once, the step is then
                       ``distinct`` as well, and all of it runs without a shuffle. With
                       ``merge_key`` it says that every row of an input that holds each key once,
                       and never a NULL one, is taken.
    """

    transform: Transform
    key: Sequence[str] = ("hash_id",)
    merge_key: Sequence[str] | None = None
    order_by: Sequence[str] = ()
    distinct: bool = False
    one_to_one: bool = False
    unchecked: bool = False
    view: str | None = None
    args: Mapping[str, object] = field(default_factory=dict)

    @property
    def upsert_key(self) -> Sequence[str]:
        return self.merge_key or self.key

    @property
    def makes_keys_distinct(self) -> bool:
        """Whether rows need no check of their keys when they are saved."""
        return self.merge_key is not None or not self.distinct or self.unchecked

    @property
    def keeps_keys(self) -> bool:
        """Whether the keys of the output are exactly those of the input."""
        return self.one_to_one and self.distinct and self.merge_key is None


@dataclass(frozen=True)
class TableSpec:
    """A source table: how to read it, and its bronze and silver steps.

    ``tracks``  how an incremental silver step knows what it has taken. ``flag``: bronze rows are
                marked as processed, which writes bronze once more. ``changes``: silver notes the
                version of bronze it was made from and reads what changed since; bronze is not
                touched, and its flag stays false. A store without versions falls back to flags.
    ``checks``  name -> condition over landing columns that a bad row meets. Such rows, and records
                the reader could not read (``LandingFormat.corrupt``), go to the bronze table
                ``<name>_rejected`` and are counted in the step's report.
    """

    name: str
    bronze: StepSpec
    silver: StepSpec
    landing: LandingFormat = LandingFormat()
    set_on_bronze: Mapping[str, str] = field(default_factory=lambda: {"processed": "true"})
    tracks: str = "flag"
    checks: Mapping[str, Column | str] = field(default_factory=dict)

    @property
    def quarantines(self) -> bool:
        return bool(self.checks) or self.landing.corrupt is not None

    def __post_init__(self) -> None:
        if self.tracks not in ("flag", "changes"):
            raise ValueError(f"tracks must be 'flag' or 'changes', not {self.tracks!r}")


@dataclass(frozen=True)
class GoldSpec:
    """A table joined from silver tables.

    ``build``       a function of the silver frames by name, or SQL text over views so named.
    ``key``         the result has one row per key, the first under ``order_by``.
    ``distinct``    the build already returns one row per key.
    ``write_back``  silver table -> key pairs (silver column, gold column); the matched
                    silver rows get ``set_on_silver``. Empty: no write-back.
    ``input_keys``  silver table -> its key; with ``touched`` and ``narrow`` a run can rebuild the
                    rows whose inputs changed only (``run_gold(incremental=True)``).
    ``touched``     from the changed rows of each silver table, and the silver tables, the gold
                    keys that may come out differently.
    ``narrow``      the silver tables cut down to the rows that meet given gold keys.
    ``after``       gold tables that ``build`` reads by itself; they are made first.
    ``stamp``       what else the result depends on, such as the day of an age: another stamp than
                    that of the last run means that all is built anew.
    """

    name: str
    tables: Sequence[str]
    build: GoldBuild
    key: Sequence[str]
    order_by: Sequence[str] = ()
    distinct: bool = False
    write_back: Mapping[str, Sequence[KeyColumn]] = field(default_factory=dict)
    set_on_silver: Mapping[str, str] = field(default_factory=lambda: {"processed": "true"})
    input_keys: Mapping[str, Sequence[str]] = field(default_factory=dict)
    touched: Callable[[Mapping[str, DataFrame], Mapping[str, DataFrame]], DataFrame] | None = None
    narrow: Callable[[Mapping[str, DataFrame], DataFrame], Mapping[str, DataFrame]] | None = None
    stamp: str = ""
    after: Sequence[str] = ()

    @property
    def propagates(self) -> bool:
        """Whether changes of the inputs can be followed to gold keys."""
        return bool(self.input_keys and self.touched and self.narrow)


@dataclass(frozen=True)
class StepResult:
    """Outcome of one step: ``ok``, ``skipped`` (nothing to do) or ``failed``.

    ``rows`` counts the stored table after the step, where the store reports it, ``rejected`` the
    different bad records among the landing files of a bronze step.
    """

    table: str
    layer: str
    status: str
    rows: int | None = None
    reason: str = ""
    rejected: int = 0
