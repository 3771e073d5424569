"""Judge-response and consensus predicates (FN-7 .. FN-13).

All JVM expressions over arrays and maps: higher-order functions stop at the
first match the way the loops they replace do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloquy.config import NO_ERROR_RANGE
from colloquy.schemas import ERROR_LIST, JUDGE_RESPONSE


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_errors() -> Column:
    return F.array().cast(ERROR_LIST)


_STRICT = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}


def _objects(response: Column | str, item: str) -> Column:
    """The JSON values of a response, read as one list: a second value or text after the object shows up as
    a longer or a null list, so exactly one object has size 1."""
    return F.from_json(F.concat(F.lit("["), _c(response), F.lit("]")), f"array<{item}>", _STRICT)


def is_object(response: Column | str) -> Column:
    """The response is exactly one JSON object (a null response is not)."""
    parsed = _objects(response, "map<string,string>")
    return F.coalesce((F.size(parsed) == 1) & F.get(parsed, 0).isNotNull(), F.lit(False))


def parse_errors(response: Column | str) -> Column:
    """FN-7: the ``errors`` list of a response that is one JSON object; anything else -> []."""
    parsed = _objects(response, JUDGE_RESPONSE.simpleString())
    return F.coalesce(F.when(F.size(parsed) == 1, F.get(parsed, 0).getField("errors")), empty_errors())


def is_actual_error(item: Column) -> Column:
    """FN-9: an item whose lines are not [-1, -1]; a missing ``lines`` counts as an error."""
    lines = F.coalesce(item.getField("lines"), F.array().cast("array<int>"))
    no_error = (
        (F.size(lines) == 2)
        & F.coalesce(F.get(lines, 0) == NO_ERROR_RANGE[0], F.lit(False))
        & F.coalesce(F.get(lines, 1) == NO_ERROR_RANGE[1], F.lit(False))
    )
    return ~no_error


def has_actual(errors: Column | str) -> Column:
    return F.exists(_c(errors), is_actual_error)


def contract_ok(response: Column | str) -> Column:
    """FN-8: one object with the field ``errors`` alone, whose items have two line numbers, a reason and nothing else.

    A failed or malformed answer does not keep the contract."""
    parsed = F.get(_objects(response, "map<string,string>"), 0)
    raw = F.get(_objects(response, "struct<errors:array<map<string,string>>>"), 0).getField("errors")
    fields = F.forall(raw, lambda e: F.array_sort(F.map_keys(e)) == F.array(F.lit("lines"), F.lit("reason")))
    typed = F.get(_objects(response, JUDGE_RESPONSE.simpleString()), 0).getField("errors")
    complete = F.forall(
        typed,
        lambda e: (F.size(F.coalesce(e.getField("lines"), F.array().cast("array<int>"))) == 2)
        & F.forall(e.getField("lines"), lambda n: n.isNotNull())
        & e.getField("reason").isNotNull(),
    )
    return is_object(response) & F.coalesce((F.map_keys(parsed) == F.array(F.lit("errors"))) & fields & complete, F.lit(False))


def drop_empty_judges(errors_by_model: Column | str) -> Column:
    """FIL-8: judges that returned an empty list are not kept in the map."""
    return F.map_filter(_c(errors_by_model), lambda k, v: F.size(v) > 0)


def any_actual(errors_by_model: Column | str) -> Column:
    """FN-10: some judge reported some actual error."""
    return F.exists(F.map_values(_c(errors_by_model)), lambda es: F.exists(es, is_actual_error))


def models_with_actual(errors_by_model: Column | str) -> Column:
    """FN-11b: names of judges with an actual error, in map (judge) order."""
    return F.map_keys(F.map_filter(_c(errors_by_model), lambda k, v: F.exists(v, is_actual_error)))


def count_models_with_actual(errors_by_model: Column | str) -> Column:
    """FN-11a."""
    return F.size(models_with_actual(errors_by_model))


def majority(n_flagging: Column, n_models: int) -> Column:
    """FN-12: strictly more than half of the configured judges."""
    return n_flagging * 2 > F.lit(n_models)


def unanimous(models_with_errors: Column | str, n_models: int) -> Column:
    """AGG-15: every configured judge flagged (a missing verdict blocks it)."""
    return F.size(_c(models_with_errors)) == F.lit(n_models)


def percentage(part: Column, whole: Column) -> Column:
    """FN-13: 100 * part / whole rounded half-even to 2 places; 0 when whole is 0.

    Exact integer arithmetic, so every engine gives the same value; it equals
    binary-float rounding except on exact decimal ties.
    """
    num = part.cast("long") * 10000
    q = F.floor(num / whole).cast("long")
    r2 = (num - q * whole) * 2
    rounded = F.when(r2 > whole, q + 1).when((r2 == whole) & (q % 2 == 1), q + 1).otherwise(q)
    return F.when(whole > 0, rounded / F.lit(100.0)).otherwise(F.lit(0.0))
