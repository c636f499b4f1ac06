"""Label expressions: raw catalogue class -> training class."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from alertflow import schemas as S


def map_label(raw: Column | str, mapping: dict[str, str] = S.LABEL_MAP,
              fallback: str = S.FALLBACK_CLASS) -> Column:
    """Literal-map lookup; unmapped and null classes -> fallback.

    The map is a literal (15 entries), folded into the expression: no join,
    no broadcast, stays inside whole-stage codegen.
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, raw), F.lit(fallback))
