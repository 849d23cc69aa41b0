"""Registry of named results over gold: name -> (label, builder).

Adding, dropping or reordering a published answer is one edit here. Every
ordering carries the keys as tie-breakers so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tiermill.operators.layers import Golds
from tiermill.operators.ranking import order_desc, top_n
from tiermill.schemas import GOLD_KEYS, GOLD_MEASURE

_OP = GOLD_KEYS["beneficiarios_por_operadora"]
_FX = GOLD_KEYS["beneficiarios_por_faixa_etaria"]
_MU = GOLD_KEYS["beneficiarios_por_municipio"]


@dataclass(frozen=True)
class NamedResult:
    name: str
    build: Callable[[Golds], DataFrame]
    label: str | None = None

    @property
    def title(self) -> str:
        return self.label or self.name


def _sorted(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, GOLD_MEASURE).orderBy(*order_desc(GOLD_MEASURE, keys))


def _register(*items: NamedResult) -> dict[str, NamedResult]:
    out: dict[str, NamedResult] = {}
    for item in items:
        if not item.name:
            raise ValueError("a named result needs a name")
        if item.name in out:
            raise ValueError(f"duplicate result name: {item.name}")
        out[item.name] = item
    return out


RESULTS: dict[str, NamedResult] = _register(
    NamedResult(
        "a_top5_operadoras",
        lambda g: top_n(g.operadora.select(*_OP, GOLD_MEASURE), GOLD_MEASURE, _OP, 5),
        "(a) Top 5 operators by active beneficiaries",
    ),
    NamedResult(
        "b_faixa_etaria_top",
        lambda g: top_n(g.faixa.select(*_FX, GOLD_MEASURE), GOLD_MEASURE, _FX, 1),
        "(b) Age band with most beneficiaries",
    ),
    NamedResult(
        "c_beneficiarios_por_municipio",
        lambda g: _sorted(g.municipio, _MU),
        "(c) Beneficiaries per municipality, descending",
    ),
    NamedResult("insight_operadoras", lambda g: _sorted(g.operadora, _OP)),
    NamedResult("insight_faixa_etaria", lambda g: _sorted(g.faixa, _FX)),
)


def register_result(
    name: str, build: Callable[[Golds], DataFrame], label: str | None = None, *, replace: bool = False
) -> None:
    """Add a named result (published by the results step, in insertion order)."""
    if not name:
        raise ValueError("a named result needs a name")
    if name in RESULTS and not replace:
        raise ValueError(f"duplicate result name: {name}")
    RESULTS[name] = NamedResult(name, build, label)


def unregister_result(name: str) -> None:
    """Drop a named result; an unknown name raises ``KeyError``."""
    del RESULTS[name]


def result_names() -> list[str]:
    return list(RESULTS)


def result(golds: Golds, name: str) -> DataFrame:
    """Build one named result; an unknown name raises ``KeyError``."""
    try:
        item = RESULTS[name]
    except KeyError:
        raise KeyError(f"unknown result: {name!r}; known: {', '.join(RESULTS)}") from None
    return item.build(golds)
