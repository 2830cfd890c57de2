"""Clean a source that already carries codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from matchwright.fixed_values import CONNECTOR_RULES
from matchwright.functions.columns import as_integer, move_first
from matchwright.functions.names import normalize_names


def clean_coded_source(
    raw: DataFrame,
    renames: Mapping[str, str],
    name: str,
    code: str,
    rules: Sequence[tuple[str, str]] = CONNECTOR_RULES,
) -> DataFrame:
    """Rename headers, title-case names with the connector rules, integer codes.

    One narrow stage: no shuffle. Order it with ``sort_nulls_last`` on output.
    """
    out = raw.withColumnsRenamed(dict(renames))
    out = out.withColumns({name: normalize_names(name, rules), code: as_integer(code)})
    return move_first(out, name, code)
