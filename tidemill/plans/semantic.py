"""A small semantic layer: declared views and measures, compiled to one DataFrame query.

A model is a plain dict::

    {"base": "lineitem",
     "joins": {"orders": ("l_orderkey = o_orderkey", "many_to_one")},  # view -> condition, rows of the view it builds on to its own
     "keys": {"orders": ["o_orderkey"]},                      # view -> columns that tell its rows apart
     "needs": {"customer": "orders"},                         # a join that builds on another
     "dimensions": {"status": ("orders", "o_orderstatus")},   # name -> (view, SQL expression)
     "date_groups": {"ordered": ("orders", "o_orderdate")},   # ordered_month, ordered_year, ..
     "measures": {"sales": ("lineitem", "sum", "l_extendedprice"),
                  "orders": ("orders", "count_distinct", "o_orderkey"),
                  "margin": (None, "ratio", ("profit", "sales"))},
     "parameters": {"profit_or_sales": {"profit": "profit", "sales": "sales"}}}

Only the views a query mentions are joined. A ratio is the quotient of two aggregates.

A join may repeat the rows of a view: an order comes once per lineitem. Counts and sums of such a view are folded to one value per group
and key of the view before they are added up, so that an order counts once in each group it falls in. Which joins repeat rows follows from
their declared cardinalities; a count or sum whose rows might be repeated by a join without one is refused. Minimum, maximum and
distinct counts do not mind.

``sum`` adds numbers as they are, ``sum_money`` money with two digits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.exact import dec
from tidemill.operators.relational import union_all

GRAINS = {"date": "day", "week": "week", "month": "month", "quarter": "quarter", "year": "year"}


class ModelError(ValueError):
    pass


def _dimension(model: Mapping, name: str) -> tuple[str, Column]:
    if name in model["dimensions"]:
        view, sql = model["dimensions"][name]
        return view, F.expr(sql)
    group, _, grain = name.rpartition("_")
    if group in model.get("date_groups", {}) and grain in GRAINS:
        view, col = model["date_groups"][group]
        return view, F.date_trunc(GRAINS[grain], F.expr(col)).cast("date")
    raise ModelError(f"unknown dimension {name}")


def _aggregate(kind: str, sql: str) -> Column:
    if kind == "sum":
        return F.sum(F.expr(sql)).cast("double")
    if kind == "sum_money":
        return F.sum(dec(F.expr(sql), 2)).cast("double")
    if kind == "count":
        return F.count(F.expr(sql))
    if kind == "count_distinct":
        return F.countDistinct(F.expr(sql))
    if kind in ("min", "max"):
        return (F.min if kind == "min" else F.max)(F.expr(sql))
    raise ModelError(f"unknown measure kind {kind}")


def _measures(model: Mapping, measures: Sequence[str], parameters: Mapping[str, str]) -> tuple[dict, dict]:
    """(measure asked for -> its definition, plain measure -> its definition)."""
    chosen = {}
    for m in measures:
        target = m
        if m in model.get("parameters", {}):
            options = model["parameters"][m]
            target = options[parameters.get(m, next(iter(options)))]
        if target not in model["measures"]:
            raise ModelError(f"unknown measure {m}")
        chosen[m] = model["measures"][target]
    plain: dict[str, tuple[str, str, str]] = {}
    for name, (view, kind, arg) in chosen.items():
        for part in (arg if kind == "ratio" else (name,)):
            plain[part] = model["measures"][part] if kind == "ratio" else (view, kind, arg)
    return chosen, plain


ADDED_UP = ("sum", "sum_money", "count")
# Whether a row meets at most one row: from the view that a join builds on to the joined one, and back.
TO_ONE = {"many_to_one": (True, False), "one_to_many": (False, True), "one_to_one": (True, True)}


def _condition(join) -> str:
    return join if isinstance(join, str) else join[0]


def _used(model: Mapping, views: set[str]) -> set[str]:
    """The joined views: those asked for, and the ones they build on."""
    out: set[str] = set()
    for view in views - {model["base"]}:
        while view != model["base"]:
            out.add(view)
            view = model.get("needs", {}).get(view, model["base"])
    return out


def _repeated(model: Mapping, view: str, used: set[str]) -> bool:
    """Whether the joins of a query may give a row of the view more than once."""
    links: dict[str, list[tuple[str, bool]]] = {}
    for child in used:
        parent = model.get("needs", {}).get(child, model["base"])
        join = model["joins"][child]
        if isinstance(join, str) or join[1] not in TO_ONE:
            raise ModelError(f"the join of {child} declares no cardinality, so counts and sums over it may be wrong")
        out, back = TO_ONE[join[1]]
        links.setdefault(parent, []).append((child, out))
        links.setdefault(child, []).append((parent, back))
    seen, todo, repeated = {view}, [view], False
    while todo:
        for other, to_one in links.get(todo.pop(), []):
            if other not in seen:
                seen.add(other)
                todo.append(other)
                repeated = repeated or not to_one
    return repeated


def _fold_keys(model: Mapping, plain: Mapping, used: set[str]) -> dict[str, list[str]]:
    """Plain measures that must be folded at their view's own rows first, with the view's key."""
    out = {}
    for name, (view, kind, _) in plain.items():
        if kind in ADDED_UP and _repeated(model, view, used):
            if view not in model.get("keys", {}):
                raise ModelError(f"rows of {view} are repeated by the query's joins, and the model declares no key for it")
            out[name] = list(model["keys"][view])
    return out


def _joined(tables: Mapping[str, DataFrame], model: Mapping, views: set[str], filters: Mapping[str, object]) -> DataFrame:
    """The base view joined to those views and the ones they or the filters need, filtered."""
    tests = {f: _dimension(model, f) for f in filters}
    wanted = views | {v for v, _ in tests.values()}
    df, joined = tables[model["base"]], {model["base"]}

    def join(view: str) -> None:
        nonlocal df
        if view in joined:
            return
        if view in model.get("needs", {}):
            join(model["needs"][view])
        df = df.join(tables[view], F.expr(_condition(model["joins"][view])), "left")
        joined.add(view)
    for view in model["joins"]:  # in declared order, so that plans are stable
        if view in wanted:
            join(view)
    for name, value in filters.items():
        col = tests[name][1]
        if isinstance(value, tuple):
            df = df.where(col.between(*value))
        else:
            df = df.where(col.isin(*value) if isinstance(value, list) else col == value)
    return df


def _answers(grouped: DataFrame, first: Sequence[str], chosen: Mapping) -> DataFrame:
    out = []
    for name, (_, kind, arg) in chosen.items():
        value = F.col(f"_{arg[0]}") / F.nullif(f"_{arg[1]}", F.lit(0)) if kind == "ratio" else F.col(f"_{name}")
        out.append(value.alias(name))
    return grouped.select(*first, *out)


def _grouped(df: DataFrame, dims: Mapping[str, Column], chosen: Mapping, plain: Mapping, folds: Mapping[str, list[str]]) -> DataFrame:
    """Measures by dimensions. Those of a view whose rows are repeated go by way of one row per group and key of the view."""
    group = [c.alias(n) for n, c in dims.items()] or [F.lit(1).alias("_all")]
    names = list(dims) or ["_all"]
    direct = [_aggregate(kind, arg).alias(f"_{n}") for n, (_, kind, arg) in plain.items() if n not in folds]
    parts = [df.groupBy(*group).agg(*direct)] if direct else []
    for keys in dict.fromkeys(tuple(k) for k in folds.values()):
        mine = [n for n, k in folds.items() if tuple(k) == keys]
        there = F.col(keys[0]).isNotNull()  # a row that met none of the view's has nothing of it to add
        once = df.where(there).groupBy(*group, *[F.col(k).alias(f"_key_{k}") for k in keys]).agg(*[F.first(F.expr(plain[n][2])).alias(f"_arg_{n}") for n in mine])
        folded = once.groupBy(*names).agg(*[_aggregate(plain[n][1], f"_arg_{n}").alias(f"_{n}") for n in mine])
        every = df.select(*group).distinct() if not parts else None
        if every is not None:
            parts.append(every)
        parts.append(folded)
    out = parts[0]
    for part in parts[1:]:
        renamed = part.withColumnsRenamed({n: f"_r_{n}" for n in names})
        out = out.join(renamed, [F.col(n).eqNullSafe(F.col(f"_r_{n}")) for n in names], "left").drop(*[f"_r_{n}" for n in names])
    zero = {f"_{n}": F.coalesce(f"_{n}", F.lit(0)) for n in folds if plain[n][1] == "count"}
    return _answers(out.withColumns(zero) if zero else out, list(dims), chosen)


def semantic_query(tables: Mapping[str, DataFrame], model: Mapping, dimensions: Sequence[str], measures: Sequence[str],
                   filters: Mapping[str, object] | None = None, parameters: Mapping[str, str] | None = None) -> DataFrame:
    """Group the declared measures by the declared dimensions.

    ``filters`` maps a dimension to a value, a list of values, or a (low, high) pair.
    ``parameters`` picks the measure behind a parameter's name at run time.
    """
    chosen, plain = _measures(model, measures, parameters or {})
    dims = {d: _dimension(model, d) for d in dimensions}
    views = {v for v, _ in dims.values()} | {v for v, _, _ in plain.values()}
    df = _joined(tables, model, views, filters or {})
    tests = {_dimension(model, f)[0] for f in filters or {}}
    return _grouped(df, {d: c for d, (_, c) in dims.items()}, chosen, plain, _fold_keys(model, plain, _used(model, views | tests)))


def semantic_panels(tables: Mapping[str, DataFrame], model: Mapping, dimensions: Sequence[str], measures: Sequence[str],
                    filters: Mapping[str, object] | None = None, parameters: Mapping[str, str] | None = None) -> DataFrame:
    """(panel, label, measures): the same measures by each dimension on its own, the panels of one dashboard.

    The views are joined once, and one pass groups the rows by every dimension. With measures that must be folded first each panel is a
    query of its own.
    """
    chosen, plain = _measures(model, measures, parameters or {})
    dims = {d: _dimension(model, d) for d in dimensions}
    views = {v for v, _ in dims.values()} | {v for v, _, _ in plain.values()}
    tests = {_dimension(model, f)[0] for f in filters or {}}
    if _fold_keys(model, plain, _used(model, views | tests)):
        return union_all(*[semantic_query(tables, model, [d], measures, filters, parameters).select(
            F.lit(d).alias("panel"), F.col(d).cast("string").alias("label"), *chosen) for d in dims])
    rows = _joined(tables, model, views, filters or {}).select(
        *[c.alias(d) for d, (_, c) in dims.items()], *[F.expr(arg).alias(f"_arg_{n}") for n, (_, _, arg) in plain.items()])
    aggs = [_aggregate(kind, f"_arg_{n}").alias(f"_{n}") for n, (_, kind, _) in plain.items()]
    panel = F.coalesce(*[F.when(F.grouping(d) == 0, F.lit(d)) for d in dims]).alias("panel")
    grouped = rows.groupingSets([[d] for d in dims], *dims).agg(panel, *aggs)
    label = F.coalesce(*[F.when(F.col("panel") == d, F.col(d).cast("string")) for d in dims]).alias("label")
    return _answers(grouped.select("*", label), ["panel", "label"], chosen)
