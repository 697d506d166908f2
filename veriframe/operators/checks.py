"""The contract of checks, and registries that open a modality's checks all at once.

A check is an entry of a registry: a name, and a function from the modality's policy to a verdict, a column of type struct<status,
reason>. Verdicts come from `said`, or from `graded` where a check is three-valued (true: PASS, false: FAIL, null: not judged, SKIP). A
null verdict gives no row. A check may need a capability, such as a detector's model: where the column ``lacks`` (map<capability, why>)
has an entry for it, the verdict is SKIP with that reason.

All checks of a registry are one array expression over a row, opened in place, so a further check is one more entry and adds
neither a scan nor a shuffle. Limits of the roll-up (a check's own ratio of failed frames) belong to the entry as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriframe.functions.status import FAIL, PASS, SKIP, said
from veriframe.operators.report import Aggregation

#: Check rows, apart from the columns that name a file.
TAIL = ["level", "check_name", "status", "reason", "frame_index", "row_seq"]


def graded(ok: Column, *reason: Column | str) -> Column:
    """A three-valued result with its reason."""
    return F.when(ok, said(PASS, *reason)).when(~ok, said(FAIL, *reason)).otherwise(said(SKIP, *reason))


@dataclass(frozen=True)
class Check:
    name: str
    verdict: Callable[[Any], Column]
    level: str
    needs: str | None = None
    #: Whether the reason begins with the frame.
    framed: bool = False
    fail_ratio: float | None = None

    def judge(self, policy: Any) -> Column:
        v = self.verdict(policy)
        if self.needs:
            why = F.try_element_at("lacks", F.lit(self.needs))
            v = F.when(v.isNotNull(), F.when(why.isNotNull(), said(SKIP, why)).otherwise(v))
        if self.framed:
            v = F.when(v.isNotNull(), said(v["status"], "frame=", F.col("frame_index").cast("string"), " ", v["reason"]))
        return v


class Registry:
    """The checks of one kind of row (a file, a frame, a still) of a modality, in the order of their rows."""

    def __init__(self, level: str, *, framed: bool = False):
        self.level, self.framed = level, framed
        self.checks: dict[str, Check] = {}

    def check(self, name: str, *, level: str | None = None, needs: str | None = None, framed: bool | None = None, fail_ratio: float | None = None) -> Callable:
        """Registers the decorated function from policy to verdict."""

        def add(verdict: Callable[[Any], Column]) -> Callable[[Any], Column]:
            if name in self.checks:
                raise ValueError(f"{name} is registered already")
            self.checks[name] = Check(name, verdict, level or self.level, needs, self.framed if framed is None else framed, fail_ratio)
            return verdict

        return add

    def together(self, names: tuple[str, ...], verdicts: Callable[[Any], dict[str, Column]], **options: Any) -> None:
        """Registers checks whose verdicts are made together, by a function from policy to the verdict of each name."""
        made: dict[int, tuple[Any, dict[str, Column]]] = {}

        def of(policy: Any, name: str) -> Column:
            if id(policy) not in made:
                made.clear()
                made[id(policy)] = policy, verdicts(policy)
            return made[id(policy)][1][name]

        for n in names:
            self.check(n, **options)(lambda p, n=n: of(p, n))

    def __iter__(self) -> Iterator[Check]:
        return iter(self.checks.values())

    def open(self, rows: DataFrame, policy: Any, keys: list[str], *, seq: Column, frame_index: Column | None = None) -> DataFrame:
        """The check rows of each row: keys and TAIL. seq: what the row_seq of its checks begins with."""
        each = [F.struct(F.lit(c.level).alias("level"), F.lit(c.name).alias("check_name"), c.judge(policy).alias("v"), (seq + k).alias("row_seq")) for k, c in enumerate(self)]
        at = (F.lit(None) if frame_index is None else frame_index).cast("int").alias("frame_index")
        out = rows.select(*keys, at, F.explode(F.filter(F.array(*each), lambda x: x["v"].isNotNull())).alias("x"))
        return out.select(*keys, "x.level", "x.check_name", "x.v.status", "x.v.reason", "frame_index", "x.row_seq")


def aggregation(*registries: Registry, fail_ratio: float = 0.2, review_ratio: float = 0.2) -> Aggregation:
    """The roll-up's limits, with those that checks set for themselves."""
    return Aggregation(fail_ratio, review_ratio, {c.name: c.fail_ratio for r in registries for c in r if c.fail_ratio is not None})
