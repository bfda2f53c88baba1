"""The registered queries once more, as SQL for an independent engine.

Written from the definitions, not from the Spark plans: labels come from
shifting all columns down one row, positions from one plain window, splits from
ranking every hash, the model from its two-feature closed form.
"""

from __future__ import annotations

from lunario import schema
from lunario.plans.queries import DIGITS, HEADER_ONLY, LINE_NUMBERS, LINEAR_GRID, MODEL, SMALL_GRID, SQUARE_GRID
from lunario.plans.standins import GDP_MODULUS, INDEX_MODULUS, LAYOUT, MONTH_NAMES
from lunario.schema import FULL, Layout, rolling_name

PRICE = LAYOUT.price
KEYS = "series, anio, mes"
BINS = 10


def _round(expression: str, column: str, alias: str | None = None) -> str:
    return f"round({expression}, {DIGITS[column]}) AS {alias or column}"


def _dotted(number: str, from_left: str) -> str:
    digits = f"CAST({number} AS VARCHAR)"
    head = f"(CASE WHEN {from_left} THEN 3 ELSE (length({digits}) - 1) % 3 + 1 END)"
    groups = [f"substr({digits}, 1, {head})"] + [
        f"nullif(substr({digits}, {head} + {i}, 3), '')" for i in (1, 4, 7, 10, 13)
    ]
    return f"concat_ws('.', {', '.join(groups)})"


def _gdp(text: str) -> str:
    return f"CAST(replace({text}, '.', '') AS BIGINT)"


def _index(text: str) -> str:
    g0, g1 = f"split_part({text}, '.', 1)", f"split_part({text}, '.', 2)"
    both = f"({g0} || {g1})"
    return f"""CAST(CASE
        WHEN {g0} LIKE '1%' AND length({g0}) > 2 THEN {g0} || '.' || {g1}
        WHEN {g0} LIKE '1%' THEN substr({both}, 1, 3) || '.' || substr({both}, 4)
        WHEN length({g0}) > 2 THEN substr({g0}, 1, 2) || '.' || right({g0}, 1)
        ELSE substr({both}, 1, 2) || '.' || substr({both}, 3) END AS DOUBLE)"""


def _month_name(month: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(MONTH_NAMES, 1))
    return f"(CASE {month} {cases} END)"


def _int_part(part: str, column: str) -> str:
    return f"CAST({part}({column}) AS INTEGER)"


def _sums(layout: Layout) -> str:
    whole = "CAST(floor(l_extendedprice) AS BIGINT)"
    rain = [
        f"sum(CASE WHEN l_linenumber % {len(layout.rain)} = {i} THEN l_quantity ELSE 0.0::DOUBLE END) AS {c}"
        for i, c in enumerate(layout.rain)
    ]
    weighted = [
        f"CAST(sum({whole} * ((l_partkey + {i}) % {m} + 1)) AS BIGINT) AS n_{c}"
        for names, m in ((layout.gdp, GDP_MODULUS), (layout.index, INDEX_MODULUS))
        for i, c in enumerate(names)
    ]
    return ", ".join(rain + weighted)


def _bank_texts(layout: Layout) -> str:
    first, *others = layout.texts
    texts = [
        f"""CASE WHEN copy = 1 THEN '7.777.777'
            WHEN key % 10 <> 0 THEN {_dotted(f'n_{first}', 'mes % 2 = 0')} END AS {first}"""
    ]
    texts += [f"{_dotted(f'n_{c}', 'mes % 2 = 0')} AS {c}" for c in others]
    return ", ".join(texts)


def _sent(column: str, layout: Layout) -> str:
    """A bank cell as the request log writes it: plain notation where it came as a number."""
    if column not in (layout.gdp[0], layout.index[0]):
        return f"m.{column}"
    number = (_gdp if column in layout.gdp else _index)(f"m.{column}")
    plain = f"CAST(CAST({number} AS DECIMAL(38, 10)) AS VARCHAR)"
    return f"CASE WHEN as_numbers THEN {plain} ELSE m.{column} END AS {column}"


def _trailing(columns: list[str], frame: str, cast: str = "{}") -> str:
    window = f"OVER (PARTITION BY series ORDER BY anio, mes ROWS BETWEEN {frame})"
    return ", ".join(
        f"{function}({cast.format(c)}) {window} AS {rolling_name(c, method)}"
        for method, function in (("mean", "avg"), ("std", "stddev_samp"))
        for c in columns
    )


#: Terms of the small grid: the place of its last variable, its degree, its value.
CUBE = [(1, 1, "z1"), (2, 1, "z2"), (3, 1, "z3"), (1, 2, "z1 * z1"), (2, 2, "z1 * z2"), (2, 2, "z2 * z2"),
        (3, 2, "z1 * z3"), (3, 2, "z2 * z3"), (3, 2, "z3 * z3")]


def _cube() -> dict[str, str]:
    """Ridge fits of up to three features and their products, by elimination."""
    terms = ", ".join(f"{{'f': {i}, 'k': {k}, 'd': {d}, 'v': {v}}}" for i, (k, d, v) in enumerate(CUBE))
    steps = {
        "cube_systems": f"""
        SELECT held, k, d, a, list(line ORDER BY f) AS m
        FROM (SELECT held, s.k, s.d, a, f,
                     list_append(list(c + CASE WHEN f = g THEN a ELSE 0 END ORDER BY g), any_value(b)) AS line
              FROM cube_products p
              JOIN (SELECT unnest({SMALL_GRID['selector__k']}) AS k) s1 ON p.fk <= s1.k AND p.gk <= s1.k
              JOIN (SELECT unnest({SMALL_GRID['poly__degree']}) AS d) s2 ON p.fd <= s2.d AND p.gd <= s2.d
              CROSS JOIN LATERAL (SELECT s1.k AS k, s2.d AS d) s
              CROSS JOIN (SELECT CAST(unnest({SMALL_GRID['model__alpha']}) AS DOUBLE) AS a)
              GROUP BY held, s.k, s.d, a, f)
        GROUP BY held, k, d, a"""
    }
    last = "cube_systems"
    for p in range(1, len(CUBE) + 1):
        steps[f"cube_{p}"] = f"""
        SELECT held, k, d, a, CASE WHEN len(m) < {p} THEN m ELSE list_transform(m, lambda line, i:
            CASE WHEN i = {p} THEN list_transform(line, lambda x: x / line[{p}])
                 ELSE list_transform(line, lambda x, j: x - line[{p}] * m[{p}][j] / m[{p}][{p}]) END) END AS m
        FROM {last}"""
        last = f"cube_{p}"
    return {
        "cube_moments": """
        SELECT held, rank, position, avg(v) AS m, stddev_pop(v) AS s
        FROM long JOIN best USING (held, position) WHERE rank <= 3 AND held >= 0
        GROUP BY held, rank, position""",
        "cube_rows": """
        SELECT held, id, any_value(fold) = held AS is_held, any_value(y) AS y,
               sum(CASE WHEN rank = 1 THEN (v - m) / s END) AS z1,
               sum(CASE WHEN rank = 2 THEN (v - m) / s END) AS z2,
               sum(CASE WHEN rank = 3 THEN (v - m) / s END) AS z3
        FROM base_long JOIN cube_moments USING (position) GROUP BY held, id""",
        "cube_terms": f"""
        SELECT held, id, is_held, y, t.f, t.k, t.d, t.v FROM (
            SELECT held, id, is_held, y, unnest([{terms}]) AS t FROM cube_rows)""",
        "cube_means": """
        SELECT held, f, avg(v) AS mean, avg(y) AS my FROM cube_terms WHERE NOT is_held GROUP BY held, f""",
        "cube_products": """
        SELECT x.held, x.f, x.k AS fk, x.d AS fd, w.f AS g, w.k AS gk, w.d AS gd,
               count(*) * covar_pop(x.v, w.v) AS c, count(*) * covar_pop(x.v, x.y) AS b
        FROM cube_terms x JOIN cube_terms w ON x.held = w.held AND x.id = w.id
        WHERE NOT x.is_held GROUP BY ALL""",
        **steps,
        "cube_weights": f"""
        SELECT held, k, d, a, place, m[place][-1] AS w
        FROM (SELECT held, k, d, a, m, unnest(range(1, len(m) + 1)) AS place FROM {last})""",
        "cube_named": """
        SELECT s.held, s.k, s.d, s.a, n.f, s.w FROM cube_weights s JOIN (
            SELECT k, d, f, row_number() OVER (PARTITION BY k, d ORDER BY f) AS place
            FROM (SELECT DISTINCT w.k, w.d, t.f FROM cube_weights w JOIN cube_terms t ON t.k <= w.k AND t.d <= w.d)) n
          USING (k, d, place)""",
        "cube_grid": """
        SELECT a, d, k, avg(r2) AS mean_r2
        FROM (SELECT held, a, d, k, 1 - sum(power(y - p, 2)) / (count(*) * var_pop(y)) AS r2
              FROM (SELECT t.held, t.id, n.a, n.d, n.k, any_value(t.y) AS y,
                           any_value(c.my) + sum(n.w * (t.v - c.mean)) AS p
                    FROM cube_terms t JOIN cube_named n ON t.held = n.held AND t.f = n.f
                    JOIN cube_means c ON c.held = t.held AND c.f = t.f
                    WHERE t.is_held GROUP BY t.held, t.id, n.a, n.d, n.k)
              GROUP BY held, a, d, k)
        GROUP BY a, d, k""",
    }


def _ctes(layout: Layout) -> dict[str, str]:
    """The steps from the tables to the model, by name."""
    return {
        "price": f"""
            SELECT c_nationkey AS series, {_int_part('year', 'o_orderdate')} AS anio,
                   {_int_part('month', 'o_orderdate')} AS mes,
                   (CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) // count(*))
                       / 100.0::DOUBLE AS {PRICE}
            FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3""",
        "line_months": f"""
            SELECT s_nationkey AS series, {_int_part('year', 'l_shipdate')} AS anio,
                   {_int_part('month', 'l_shipdate')} AS mes, {_sums(layout)}
            FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3""",
        "rain": f"SELECT {KEYS}, {', '.join(layout.rain)} FROM line_months",
        "bank_copies": """
            SELECT m.*, copy, anio * 12 + mes + series AS key
            FROM line_months m, (SELECT unnest([0, 1]) AS copy) c
            WHERE copy = 0 OR (anio * 12 + mes + series) % 5 = 0""",
        "bank_raw": f"""
            SELECT series, (anio * 12 + mes) * 2 + copy AS source_order,
                   CASE WHEN key % 17 = 0 THEN printf('%d-13-01', anio)
                        WHEN key % 3 = 0 THEN printf('%d-%02d-01 00:00:00 UTC', anio, mes)
                        WHEN key % 3 = 1 THEN printf('%d/%02d/01', anio, mes)
                        ELSE printf('%d-%02d-01', anio, mes) END AS written,
                   {_bank_texts(layout)}
            FROM bank_copies""",
        "bank_first": """
            SELECT *, row_number() OVER (PARTITION BY series, day ORDER BY source_order) AS nth
            FROM (SELECT *, try_strptime(written, ['%Y-%m-%d', '%Y-%m-%d %H:%M:%S UTC', '%Y/%m/%d'])
                      AS day FROM bank_raw)""",
        "bank": f"""
            SELECT series, {_int_part('year', 'day')} AS anio, {_int_part('month', 'day')} AS mes,
                   {', '.join(layout.texts)}
            FROM bank_first
            WHERE nth = 1 AND day IS NOT NULL
              AND {' AND '.join(f'{c} IS NOT NULL' for c in layout.texts)}""",
        "joined": """
            SELECT * FROM price JOIN rain USING (series, anio, mes)
            JOIN bank USING (series, anio, mes)""",
        "shifted": f"""
            SELECT series, {', '.join(f'lag({c}) OVER w AS {c}' for c in layout.merged)},
                   {PRICE} AS target
            FROM joined WINDOW w AS (PARTITION BY series ORDER BY anio, mes)""",
        "merged": f"""
            SELECT * FROM shifted
            WHERE {' AND '.join(f'{c} IS NOT NULL' for c in [*layout.merged, 'target'])}""",
        "repaired": f"""
            SELECT {KEYS}, target, {', '.join([PRICE, *layout.rain])},
                   {', '.join(f'{_gdp(c)} AS {c}' for c in layout.gdp)},
                   {', '.join(f'{_index(c)} AS {c}' for c in layout.index)}
            FROM merged""",
        "rolled": f"""
            SELECT *, anio || '-' || mes AS Periodo,
                   {_trailing(layout.values, '2 PRECEDING AND CURRENT ROW', 'CAST({} AS DOUBLE)')}
            FROM repaired""",
        "complete": f"""
            SELECT series, Periodo, target, {', '.join(layout.features)} FROM rolled
            WHERE {rolling_name(PRICE, 'std')} IS NOT NULL""",
        "split": """
            SELECT *, CAST(row_number() OVER (ORDER BY md5(concat_ws('|', '42', series, Periodo)))
                           <= ceil(0.2 * count(*) OVER ()) AS INTEGER) AS is_test
            FROM complete""",
        "train": """
            SELECT *, concat_ws('|', series, Periodo) AS id,
                   ntile(3) OVER (ORDER BY md5(concat_ws('|', '42', series, Periodo))) - 1 AS fold
            FROM split WHERE is_test = 0""",
        "base_long": " UNION ALL ".join(
            f"SELECT id, fold, target AS y, {i} AS position, '{c}' AS feature, CAST({c} AS DOUBLE) AS v,\n            CAST({c} AS FLOAT) AS fv, CAST(target AS FLOAT) AS fy FROM train"
            for i, c in enumerate(layout.features)
        ),
        # Fitting rows of every fold; fold -1 holds nothing out.
        "long": """
            SELECT held, b.* FROM base_long b, (SELECT unnest([-1, 0, 1, 2]) AS held)
            WHERE fold <> held""",
        "ranked": """
            SELECT *, row_number() OVER (PARTITION BY held, position ORDER BY fv) AS rv,
                   row_number() OVER (PARTITION BY held, position ORDER BY fy) AS ry,
                   count(*) OVER (PARTITION BY held, position) AS n
            FROM long""",
        "edges": f"""
            SELECT held, position, {', '.join(
                f"max(CASE WHEN r{s} = ceil(CAST(0.{i} AS DOUBLE) * n) THEN f{s} END) AS {s}{i}"
                for s in 'vy' for i in range(1, BINS))}
            FROM ranked GROUP BY held, position""",
        "cells": f"""
            SELECT held, position, feature, {' + '.join(f'(fv > v{i})::INT' for i in range(1, BINS))} AS bx,
                   {' + '.join(f'(fy > y{i})::INT' for i in range(1, BINS))} AS by_,
                   count(*)::DOUBLE AS n
            FROM long JOIN edges USING (held, position) GROUP BY ALL""",
        "scores": """
            SELECT held, position, feature, round(sum(n / t * ln(n * t / (x * y))), 9) AS score
            FROM (SELECT held, position, feature, n, sum(n) OVER (PARTITION BY held, position) AS t,
                         sum(n) OVER (PARTITION BY held, position, bx) AS x,
                         sum(n) OVER (PARTITION BY held, position, by_) AS y FROM cells)
            GROUP BY held, position, feature""",
        "best": """
            SELECT held, position, feature,
                   row_number() OVER (PARTITION BY held ORDER BY score DESC, position DESC) AS rank
            FROM scores""",
        "moments": """
            SELECT held, rank, position, avg(v) AS m, stddev_pop(v) AS s
            FROM long JOIN best USING (held, position) WHERE rank <= 2 GROUP BY held, rank, position""",
        "sums": """
            SELECT held, count(*) * var_pop(z1) AS s11, count(*) * var_pop(z2) AS s22,
                   count(*) * covar_pop(z1, z2) AS s12, count(*) * covar_pop(z1, y) AS s1y,
                   count(*) * covar_pop(z2, y) AS s2y, avg(y) AS my
            FROM (SELECT held, id, any_value(y) AS y, sum(CASE WHEN rank = 1 THEN (v - m) / s END) AS z1,
                         sum(CASE WHEN rank = 2 THEN (v - m) / s END) AS z2
                  FROM long JOIN moments USING (held, position) GROUP BY held, id)
            GROUP BY held""",
        "fits": f"""
            SELECT held, k, a, my,
                   CASE k WHEN 1 THEN s1y / (s11 + a)
                        ELSE ((s22 + a) * s1y - s12 * s2y) / ((s11 + a) * (s22 + a) - s12 * s12)
                        END AS w1,
                   CASE k WHEN 1 THEN 0
                        ELSE ((s11 + a) * s2y - s12 * s1y) / ((s11 + a) * (s22 + a) - s12 * s12)
                        END AS w2
            FROM sums, (SELECT unnest([1, 2]) AS k),
                 (SELECT CAST(unnest({LINEAR_GRID['model__alpha']}) AS DOUBLE) AS a)""",
        "fitted": f"""
            SELECT * FROM fits
            WHERE held = -1 AND k = 2 AND a = CAST({MODEL['model__alpha']} AS DOUBLE)""",
        "held_out": """
            SELECT held, id, any_value(y) AS y, sum(CASE WHEN rank = 1 THEN (v - m) / s END) AS z1,
                   sum(CASE WHEN rank = 2 THEN (v - m) / s END) AS z2
            FROM base_long JOIN moments ON fold = held AND moments.position = base_long.position
            GROUP BY held, id""",
        "grid": """
            SELECT a, k, avg(r2) AS mean_r2
            FROM (SELECT held, a, k, 1 - sum(power(y - my - w1 * z1 - w2 * z2, 2))
                                         / (count(*) * var_pop(y)) AS r2
                  FROM held_out JOIN fits USING (held) GROUP BY held, a, k)
            GROUP BY a, k""",
        # One feature and its square, for the degrees 1 and 2.
        "squares": """
            SELECT held, (v - m) / s AS z, power((v - m) / s, 2) AS zz, y
            FROM long JOIN moments USING (held, position) WHERE rank = 1""",
        "square_sums": """
            SELECT held, count(*) * var_pop(z) AS s11, count(*) * var_pop(zz) AS s22,
                   count(*) * covar_pop(z, zz) AS s12, count(*) * covar_pop(z, y) AS s1y,
                   count(*) * covar_pop(zz, y) AS s2y, avg(y) AS my, avg(z) AS mz, avg(zz) AS mzz
            FROM squares GROUP BY held""",
        "square_fits": f"""
            SELECT held, d, a, my, mz, mzz,
                   CASE d WHEN 1 THEN s1y / (s11 + a)
                        ELSE ((s22 + a) * s1y - s12 * s2y) / ((s11 + a) * (s22 + a) - s12 * s12)
                        END AS w1,
                   CASE d WHEN 1 THEN 0
                        ELSE ((s11 + a) * s2y - s12 * s1y) / ((s11 + a) * (s22 + a) - s12 * s12)
                        END AS w2
            FROM square_sums, (SELECT unnest([1, 2]) AS d),
                 (SELECT CAST(unnest({SQUARE_GRID['model__alpha']}) AS DOUBLE) AS a)""",
        "square_grid": """
            SELECT a, d, avg(r2) AS mean_r2
            FROM (SELECT held, a, d, 1 - sum(power(y - my - w1 * (z1 - mz) - w2 * (z1 * z1 - mzz), 2))
                                         / (count(*) * var_pop(y)) AS r2
                  FROM held_out JOIN square_fits USING (held) GROUP BY held, a, d)
            GROUP BY a, d""",
        "all_long": " UNION ALL ".join(
            f"SELECT series, Periodo, target, is_test, {i} AS position, CAST({c} AS DOUBLE) AS v FROM split"
            for i, c in enumerate(layout.features)
        ),
        "predicted": """
            SELECT series, Periodo, target, is_test,
                   round(any_value(my) + sum((CASE WHEN rank = 1 THEN w1 ELSE w2 END) * (v - m) / s), 1)
                       AS preds
            FROM all_long JOIN moments USING (position) JOIN fitted USING (held) GROUP BY ALL""",
        "numbered": """
            SELECT *, row_number() OVER (PARTITION BY series ORDER BY anio, mes) AS nth,
                   anio * 12 + mes + series AS key FROM merged""",
        "asked": f"""
            SELECT concat_ws('|', series, anio || '-' || mes) AS request_id, series, nth, key % 7 = 0 AS as_numbers,
               key % 5 = 0 AS is_bare,
                   CASE WHEN key % 11 = 0 THEN 'missing {layout.rain[0]}'
                        WHEN key % 13 = 0 THEN 'length of {layout.gdp[0]} is 2'
                        WHEN key % 17 = 0 THEN 'length of {layout.gdp[0]} is 4'
                        ELSE 'ok' END AS reason
            FROM numbered WHERE nth >= 3""",
        "asked_rows": f"""
            SELECT request_id, CAST(m.nth - a.nth + 2 AS INTEGER) AS pos,
                   {', '.join(f'm.{c}' for c in [*schema.TIME_COLS, PRICE, *layout.rain])},
                   {', '.join(_sent(c, layout) for c in layout.texts)}
            FROM asked a JOIN numbered m ON m.series = a.series AND m.nth BETWEEN a.nth - 2 AND a.nth
            WHERE reason = 'ok'""",
        "answered": """
            SELECT request_id, preds AS pred
            FROM asked a JOIN predicted p ON a.request_id = concat_ws('|', p.series, p.Periodo)
            WHERE reason = 'ok'""",
        "quality": """
            SELECT count(*) AS n, avg(power(l_extendedprice - l_quantity * p_retailprice, 2)) AS mse,
                   var_pop(l_extendedprice) AS spread
            FROM lineitem JOIN part ON l_partkey = p_partkey""",
        **_cube(),
    }


# Each table and what it is made from, so that a query names only its last step.
NEEDS = {
    "rain": ["line_months"],
    "bank_copies": ["line_months"],
    "bank_raw": ["bank_copies"],
    "bank_first": ["bank_raw"],
    "bank": ["bank_first"],
    "joined": ["price", "rain", "bank"],
    "shifted": ["joined"],
    "merged": ["shifted"],
    "repaired": ["merged"],
    "rolled": ["repaired"],
    "complete": ["rolled"],
    "split": ["complete"],
    "train": ["split"],
    "base_long": ["train"],
    "long": ["base_long"],
    "ranked": ["long"],
    "edges": ["ranked", "long"],
    "cells": ["edges"],
    "scores": ["cells"],
    "best": ["scores"],
    "moments": ["best"],
    "sums": ["moments", "long"],
    "fits": ["sums"],
    "fitted": ["fits"],
    "held_out": ["base_long", "moments"],
    "grid": ["held_out", "fits"],
    "squares": ["moments", "long"],
    "square_sums": ["squares"],
    "square_fits": ["square_sums"],
    "square_grid": ["held_out", "square_fits"],
    "cube_moments": ["best", "long"],
    "cube_rows": ["cube_moments", "base_long"],
    "cube_terms": ["cube_rows"],
    "cube_means": ["cube_terms"],
    "cube_products": ["cube_terms"],
    "cube_systems": ["cube_products"],
    "cube_1": ["cube_systems"],
    **{f"cube_{p}": [f"cube_{p - 1}"] for p in range(2, len(CUBE) + 1)},
    "cube_weights": [f"cube_{len(CUBE)}"],
    "cube_named": ["cube_weights", "cube_terms"],
    "cube_grid": ["cube_named", "cube_means"],
    "all_long": ["split"],
    "predicted": ["fitted", "moments", "all_long"],
    "numbered": ["merged"],
    "asked": ["numbered"],
    "asked_rows": ["asked"],
    "answered": ["predicted", "asked"],
}


def _with(*names: str, layout: Layout = LAYOUT) -> str:
    wanted: set[str] = set()
    queue = list(names)
    while queue:
        name = queue.pop()
        if name not in wanted:
            wanted.add(name)
            queue += NEEDS.get(name, [])
    parts = [f"{name} AS MATERIALIZED ({sql})" for name, sql in _ctes(layout).items() if name in wanted]
    return "WITH " + ",\n".join(parts) + "\n"


def _feature_columns() -> str:
    columns = []
    for method in ("mean", "std"):
        columns += [_round(rolling_name(c, method), c, rolling_name(c, method)) for c in LAYOUT.values]
    columns += [c if c in LAYOUT.gdp else _round(c, c) for c in LAYOUT.values]
    return ", ".join(columns)


def _by_priority(expression: str) -> str:
    return f"{expression} OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey)"


def _log(layout: Layout = LAYOUT) -> str:
    columns = f"request_id, pos, anio, mes, {_round(PRICE, PRICE)}, {', '.join(layout.texts)}, pred"
    return f"SELECT {columns} FROM asked_rows JOIN answered USING (request_id)"


QUALITY = """SELECT n, round(mse, 1) AS mse, round(sqrt(mse), 4) AS rmse,
                    round(1 - mse / spread, 8) AS r2 FROM quality"""
CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
WRITTEN = f"""SELECT l_orderkey, l_linenumber, {_dotted(CENTS, 'l_linenumber % 2 = 0')} AS written
              FROM lineitem"""
ORDER_HASH = "md5(concat_ws('|', '42', o_orderkey))"
PRICE_VALUES = [PRICE, *LAYOUT.rain]


def _rolling_orders(method: str, function: str) -> str:
    name = rolling_name("o_totalprice", method)
    frame = "(PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey ROWS 2 PRECEDING)"
    return f"""SELECT o_orderpriority, o_orderkey,
                      coalesce(round({function}(o_totalprice) OVER {frame}, 3), -1.0) AS {name}
               FROM orders"""


def oracle_sql() -> dict[str, str]:
    lag_window = "OVER (PARTITION BY series ORDER BY anio, mes ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"
    fused = ", ".join(
        _round(f"{f}({c}) {lag_window}", c, rolling_name(c, m))
        for m, f in (("mean", "avg"), ("std", "stddev_samp"))
        for c in PRICE_VALUES
    )
    event_frame = "(PARTITION BY event_type ORDER BY ts, event_id ROWS 5 PRECEDING)"
    test_predictions = _with("predicted") + (
        "SELECT series, Periodo, preds FROM predicted WHERE is_test = 1"
    )
    ship = "l_shipdate"
    return {
        "csv_roundtrip": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders",
        "csv_quarantine": f"""
            SELECT o_orderkey, CASE WHEN reason = 'ok' THEN round(o_totalprice, 2) ELSE -1.0 END AS o_totalprice,
                   reason
            FROM (SELECT *, CASE WHEN o_orderkey % 83 = 0 OR o_orderkey % 89 = 0 THEN 'wrong number of cells'
                                 WHEN o_orderkey % 97 = 0 THEN 'o_totalprice is no double: n/a'
                                 ELSE 'ok' END AS reason FROM orders)""",
        "collect_price": _with("price") + f"SELECT {KEYS}, {_round(PRICE, PRICE)} FROM price",
        "collect_weather": _with("rain") + "SELECT * FROM rain",
        "collect_finance": _with("bank") + "SELECT * FROM bank",
        "metrics_json": _with("quality") + QUALITY,
        "model_roundtrip": test_predictions,
        "project_strict": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
        "take_columns": "SELECT o_totalprice, o_orderkey, o_orderpriority FROM orders",
        "dropna_any": """SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount
                         FROM lineitem WHERE l_linenumber <> 7 AND l_returnflag <> 'A'""",
        "join_two": _with("price", "rain")
        + f"""SELECT {KEYS}, {_round(PRICE, PRICE)}, {', '.join(LAYOUT.rain)}
              FROM price JOIN rain USING (series, anio, mes)""",
        "join_three": _with("joined")
        + f"""SELECT {KEYS}, {_round(PRICE, PRICE)}, {', '.join([*LAYOUT.rain, *LAYOUT.texts])}
              FROM joined""",
        "merge_sources": _with("merged")
        + f"""SELECT {KEYS}, {_round(PRICE, PRICE)}, {', '.join([*LAYOUT.rain, *LAYOUT.texts])},
                     {_round('target', PRICE, 'target')} FROM merged""",
        "period_lookup": _with("price")
        + f""", smoothed AS (
                SELECT series, anio || '-' || mes AS Periodo, avg({PRICE}) OVER
                    (PARTITION BY series ORDER BY anio, mes ROWS 2 PRECEDING) AS preds FROM price),
            lookups AS (
                SELECT o_orderkey AS request_id, c_nationkey AS series,
                       CASE WHEN o_orderkey % 50 = 0 THEN NULL
                            WHEN o_orderkey % 51 = 0 THEN year(o_orderdate) || '-13'
                            ELSE year(o_orderdate) || '-' || month(o_orderdate) END AS Periodo
                FROM orders JOIN customer ON o_custkey = c_custkey)
            SELECT request_id, coalesce(round(preds, 4), -1.0) AS prediction,
                   CASE WHEN l.Periodo IS NULL THEN 'missing argument'
                        WHEN preds IS NULL THEN 'invalid period' ELSE 'ok' END AS status
            FROM lookups l LEFT JOIN smoothed USING (series, Periodo)""",
        "dedupe_first": """
            SELECT coalesce(strftime(day, '%Y-%m-%d'), 'none') AS day, o_orderkey, o_totalprice
            FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY o_orderkey) AS nth
                  FROM (SELECT o_orderkey, o_totalprice,
                               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END AS day
                        FROM orders))
            WHERE nth = 1""",
        "validate_nonempty": _with("complete")
        + f"""SELECT 'train' AS table_name, count(*) AS n_rows,
                     CAST({1 + len(LAYOUT.features)} AS INTEGER) AS n_columns,
                     count(*) > 0 AS valid FROM complete
              UNION ALL
              SELECT 'feature_store', count(*), CAST({1 + len(LAYOUT.features)} AS INTEGER),
                     count(*) > 0 FROM complete""",
        "eval_mse_rmse_r2": _with("quality") + QUALITY,
        "promotion_gate": _with("quality")
        + f"SELECT *, mse > 0 AND r2 > 0 AS promoted FROM ({QUALITY})",
        "drift_report": _with("all_long", "edges")
        + f"""
            , marked AS (
                SELECT a.position, is_test, {' + '.join(f'(CAST(v AS FLOAT) > v{i})::INT' for i in range(1, BINS))} AS bin
                FROM all_long a JOIN edges e ON a.position = e.position AND e.held = -1),
            sides AS (
                SELECT position, bin, count(*) FILTER (is_test = 0) AS b, count(*) FILTER (is_test = 1) AS c
                FROM marked GROUP BY position, bin),
            grid AS (
                SELECT position, bin, coalesce(b, 0) AS b, coalesce(c, 0) AS c
                FROM (SELECT DISTINCT position FROM marked) CROSS JOIN (SELECT unnest(range({BINS + 1})) AS bin)
                LEFT JOIN sides USING (position, bin)),
            totals AS (SELECT position, sum(b) AS nb, sum(c) AS nc FROM grid GROUP BY position),
            shares AS (
                SELECT position, bin, nb, nc, (b + 0.5::DOUBLE) / (nb + {0.5 * (BINS + 1)}::DOUBLE) AS p,
                       (c + 0.5::DOUBLE) / (nc + {0.5 * (BINS + 1)}::DOUBLE) AS q,
                       abs(sum(b) OVER w / nb::DOUBLE - sum(c) OVER w / nc::DOUBLE) AS gap
                FROM grid JOIN totals USING (position) WINDOW w AS (PARTITION BY position ORDER BY bin))
            SELECT CAST(s.position AS INTEGER) AS position, f.feature, CAST(max(nb) AS BIGINT) AS n_before, CAST(max(nc) AS BIGINT) AS n_now,
                   round(sum((p - q) * ln(p / q)), 7) AS psi, round(max(gap), 7) AS ks
            FROM shares s JOIN (SELECT DISTINCT position, feature FROM base_long) f USING (position)
            GROUP BY s.position, f.feature""",
        "scaler_stats": " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, round(avg({c}), 6) AS mean,
                       round(stddev_pop({c}), 6) AS std FROM lineitem"""
            for c in LINE_NUMBERS
        ),
        "mi_scores": _with("scores")
        + "SELECT CAST(position AS INTEGER) AS position, feature, round(score, 7) AS score FROM scores"
        " WHERE held = -1",
        "mi_scores_lines": f"""
            WITH long AS MATERIALIZED ({' UNION ALL '.join(
                f"SELECT {i} AS position, '{c}' AS feature, CAST({c} AS FLOAT) AS fv, "
                "CAST(l_extendedprice AS FLOAT) AS fy, -1 AS held FROM lineitem"
                for i, c in enumerate(["l_quantity", "l_discount", "l_partkey"]))}),
            {', '.join(f'{name} AS MATERIALIZED ({_ctes(LAYOUT)[name]})' for name in ("ranked", "edges", "cells", "scores"))}
            SELECT CAST(position AS INTEGER) AS position, feature, round(score, 7) AS score FROM scores""",
        "mi_neighbours": f"""
            WITH long AS ({' UNION ALL '.join(
                f"SELECT {i} AS position, '{c}' AS feature, CAST({c} AS DOUBLE) AS x, "
                "CAST(p_retailprice AS DOUBLE) AS y, p_partkey AS id FROM part"
                for i, c in enumerate(["p_size", "p_partkey"]))}),
            scaled AS MATERIALIZED (
                SELECT position, feature, id, x / stddev_pop(x) OVER w AS x, y / stddev_pop(y) OVER w AS y,
                       count(*) OVER w AS n
                FROM long WINDOW w AS (PARTITION BY position)),
            reach AS MATERIALIZED (
                SELECT a.position, a.id, list_sort(min(greatest(abs(a.x - b.x), abs(a.y - b.y)), 3))[3] AS r,
                       count(*) FILTER (a.x = b.x AND a.y = b.y) AS same
                FROM scaled a JOIN scaled b ON a.position = b.position AND a.id <> b.id GROUP BY a.position, a.id),
            counted AS (
                SELECT a.position, a.id, any_value(r) AS r, any_value(same) AS same,
                       count(*) FILTER (abs(a.x - b.x) <= greatest(r - 4e-15 * (abs(a.x) + r), 0)) AS nx,
                       count(*) FILTER (abs(a.y - b.y) <= greatest(r - 4e-15 * (abs(a.y) + r), 0)) AS ny
                FROM scaled a JOIN reach USING (position, id) JOIN scaled b ON a.position = b.position
                GROUP BY a.position, a.id),
            harmonic AS MATERIALIZED (
                SELECT m, -0.5772156649015329::DOUBLE + coalesce(sum(1.0::DOUBLE / (m - 1)) OVER (
                           ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS psi
                FROM (SELECT unnest(range(2, 1 + (SELECT count(*) FROM part))) AS m)
                UNION ALL SELECT 1, -0.5772156649015329::DOUBLE)
            SELECT CAST(s.position AS INTEGER) AS position, s.feature,
                   round(greatest(avg(k.psi + t.psi - hx.psi - hy.psi), 0), 7) AS score
            FROM counted c JOIN scaled s USING (position, id)
            JOIN harmonic k ON k.m = CASE WHEN r > 0 THEN 3 ELSE same END
            JOIN harmonic t ON t.m = s.n JOIN harmonic hx ON hx.m = nx JOIN harmonic hy ON hy.m = ny
            GROUP BY s.position, s.feature""",
        "select_k_best": _with("best")
        + "SELECT CAST(rank AS INTEGER) AS rank, feature FROM best"
        " WHERE held = -1 AND rank <= 7",
        "ridge_1d": """
            SELECT round(slope, 5) AS slope, round(my - slope * mx, 4) AS intercept
            FROM (SELECT count(*) * covar_pop(l_quantity, l_extendedprice)
                         / (count(*) * var_pop(l_quantity) + 0.2) AS slope,
                         avg(l_quantity) AS mx, avg(l_extendedprice) AS my FROM lineitem)""",
        "lag_label": f"""
            SELECT o_orderpriority, o_orderkey, o_totalprice, target
            FROM (SELECT o_orderpriority, {_by_priority('lag(o_orderkey)')} AS o_orderkey,
                         {_by_priority('lag(o_totalprice)')} AS o_totalprice,
                         o_totalprice AS target FROM orders)
            WHERE o_orderkey IS NOT NULL""",
        "lag_rows": f"""
            SELECT * FROM (SELECT o_orderpriority, o_orderkey,
                                  {_by_priority('lag(o_totalprice)')} AS o_totalprice,
                                  {_by_priority('lag(o_custkey)')} AS previous_customer FROM orders)
            WHERE o_totalprice IS NOT NULL""",
        "rolling_mean": _rolling_orders("mean", "avg"),
        "rolling_std": _rolling_orders("std", "stddev_samp"),
        "rolling_window_n": f"""
            SELECT event_type, event_id,
                   round(avg(value) OVER {event_frame}, 5) AS value_rolling6_mean,
                   coalesce(round(stddev_samp(value) OVER {event_frame}, 5), -1.0)
                       AS value_rolling6_std
            FROM events""",
        "series_position": f"""SELECT o_orderpriority, o_orderkey,
                                      {_by_priority('row_number()')} - 1 AS position FROM orders""",
        "lag_rolling_fused": _with("price", "rain")
        + f"""SELECT * FROM (
                SELECT {KEYS}, {_round(PRICE, PRICE)}, {fused}
                FROM (SELECT * FROM price JOIN rain USING (series, anio, mes)))
              WHERE {rolling_name(PRICE, 'std')} IS NOT NULL""",
        "train_test_split": f"""
            SELECT o_orderkey, CAST(row_number() OVER (ORDER BY {ORDER_HASH})
                                    <= ceil(0.2 * count(*) OVER ()) AS INTEGER) AS is_test
            FROM orders""",
        "kfold_assign": f"""
            SELECT o_orderkey, CAST(ntile(3) OVER (ORDER BY h) - 1 AS INTEGER) AS fold
            FROM (SELECT o_orderkey, {ORDER_HASH} AS h, row_number() OVER (ORDER BY {ORDER_HASH})
                         > ceil(0.2 * count(*) OVER ()) AS train FROM orders)
            WHERE train""",
        "time_split": """
            WITH months AS (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS c
                            FROM orders GROUP BY 1),
                 newest AS (SELECT m, sum(c) OVER (ORDER BY m DESC) AS upto FROM months),
                 cut AS (SELECT max(m) AS m FROM newest
                         WHERE upto >= ceil(0.2 * (SELECT count(*) FROM orders)))
            SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) >= cut.m AS INTEGER) AS is_test
            FROM orders, cut""",
        "ordered_split": """
            SELECT event_id, CAST(row_number() OVER (ORDER BY ts DESC, event_id DESC)
                                  <= ceil(0.2 * count(*) OVER ()) AS INTEGER) AS is_test
            FROM events""",
        "parse_month_es": f"SELECT o_orderkey, {_int_part('month', 'o_orderdate')} AS mes FROM orders",
        "parse_date_lenient": f"""
            SELECT l_orderkey, l_linenumber, coalesce(strftime(try_strptime(written,
                ['%Y-%m-%d', '%Y-%m-%d %H:%M:%S UTC', '%Y/%m/%d', '%Y%m%d', '%m/%d/%Y',
                 '%m-%d-%Y', '%d-%m-%Y', '%Y/%m/%d %H:%M:%S', '%m/%d/%Y %H:%M', '%d.%m.%Y',
                 '%d %b %Y', '%d %b %Y']), '%Y-%m-%d'),
                 strftime(try_strptime('1 ' || written, '%d %b %Y'), '%Y-%m-%d'), 'none') AS day
            FROM (SELECT l_orderkey, l_linenumber, CASE l_orderkey % 8
                    WHEN 0 THEN strftime({ship}, '%Y-%m-%d')
                    WHEN 1 THEN strftime({ship}, '%Y-%m-%d') || ' 00:00:00 UTC'
                    WHEN 2 THEN strftime({ship}, '%Y/%m/%d')
                    WHEN 3 THEN strftime({ship}, '%Y%m%d')
                    WHEN 4 THEN strftime({ship}, '%m/%d/%Y')
                    WHEN 5 THEN strftime({ship}, '%d-%m-%Y')
                    WHEN 6 THEN strftime({ship}, '%Y') || '-13-01'
                    ELSE CASE l_linenumber
                    WHEN 1 THEN strftime({ship}, '%Y/%m/%d %H:%M:%S')
                    WHEN 2 THEN strftime({ship}, '%m/%d/%Y %H:%M')
                    WHEN 3 THEN strftime({ship}, '%d.%m.%Y')
                    WHEN 4 THEN strftime({ship}, '%-d %b %Y')
                    WHEN 5 THEN strftime({ship}, '%b %Y')
                    ELSE 'garbage' END END AS written FROM lineitem)""",
        "period_label": """SELECT o_orderkey, year(o_orderdate) || '-' || month(o_orderdate)
                                  AS Periodo FROM orders""",
        "fix_gdp_string": f"SELECT *, {_gdp('written')} AS number FROM ({WRITTEN})",
        "fix_index_string": f"SELECT *, {_index('written')} AS number FROM ({WRITTEN})",
        "standardize": f"""
            SELECT l_orderkey, l_linenumber, {', '.join(
                f'round(({c} - m_{c}) / s_{c}, 6) AS {c}' for c in LINE_NUMBERS)}
            FROM lineitem, (SELECT {', '.join(
                f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in LINE_NUMBERS)}
                FROM lineitem)""",
        "poly_degree2": """
            SELECT l_orderkey, l_linenumber, round(l_quantity, 6) AS q,
                   round(l_quantity * l_quantity, 6) AS qq, round(l_discount, 6) AS d,
                   round(l_quantity * l_discount, 6) AS qd, round(l_discount * l_discount, 6) AS dd
            FROM lineitem""",
        "validate_requests": _with("asked")
        + "SELECT request_id, CAST(reason = 'ok' AS INTEGER) AS valid, reason FROM asked",
        "validate_requests_header": _with("asked")
        + f"""SELECT request_id, CAST(reason = 'ok' AND NOT is_bare AS INTEGER) AS valid,
                     CASE WHEN reason = 'ok' AND is_bare THEN 'missing {HEADER_ONLY}' ELSE reason END AS reason
              FROM asked""",
        "request_ids": _with("asked")
        + "SELECT CAST(1 AS BIGINT) AS ids, count(*) AS requests, count(*) AS different FROM asked",
        "request_rows": _with("asked_rows")
        + f"""SELECT request_id, pos, CAST(anio AS DOUBLE) AS anio, CAST(mes AS DOUBLE) AS mes,
                     {_round(PRICE, PRICE)}, {', '.join([*LAYOUT.rain, *LAYOUT.texts])}
              FROM asked_rows""",
        "score_requests": _with("answered") + "SELECT request_id, pred FROM answered",
        "request_log": _with("asked_rows", "answered") + _log(),
        "request_log_full": _with("asked_rows", "answered", layout=FULL) + _log(FULL),
        "request_log_head": _with("asked_rows", "answered")
        + f"{_log()} ORDER BY request_id, pos LIMIT 100",
        "stream_score": _with("asked_rows", "answered") + _log(),
        "stream_log_and_rejects": _with("asked_rows", "answered")
        + """SELECT request_id, pos, pred, 'ok' AS reason FROM asked_rows JOIN answered USING (request_id)
             UNION ALL SELECT request_id, -1, -1.0, reason FROM asked WHERE reason <> 'ok'""",
        "monthly_features": _with("complete")
        + f"""SELECT series, Periodo, {_round('target', PRICE, 'target')}, {_feature_columns()}
              FROM complete""",
        "training_table": _with("split")
        + f"""SELECT series, Periodo, {_round('target', PRICE, 'target')}, {_feature_columns()},
                     is_test FROM split""",
        "feature_store": _with("complete")
        + f"SELECT series, Periodo, {_feature_columns()} FROM complete",
        "ridge_fit": """
            WITH s AS (SELECT count(*) * var_pop(l_quantity) + 50 AS a,
                              count(*) * var_pop(l_discount) + 50 AS b,
                              count(*) * covar_pop(l_quantity, l_discount) AS c,
                              count(*) * covar_pop(l_quantity, l_extendedprice) AS p,
                              count(*) * covar_pop(l_discount, l_extendedprice) AS q,
                              avg(l_quantity) AS mq, avg(l_discount) AS md,
                              avg(l_extendedprice) AS my FROM lineitem),
                 w AS (SELECT *, (b * p - c * q) / (a * b - c * c) AS w1,
                              (a * q - c * p) / (a * b - c * c) AS w2 FROM s)
            SELECT 'l_quantity' AS term, round(w1, 4) AS weight FROM w
            UNION ALL SELECT 'l_discount', round(w2, 4) FROM w
            UNION ALL SELECT 'intercept', round(my - w1 * mq - w2 * md, 4) FROM w""",
        "grid_search": _with("cube_grid")
        + """SELECT CAST(row_number() OVER (ORDER BY a DESC, d, k) - 1 AS INTEGER) AS grid_position,
                    a AS model__alpha, CAST(d AS INTEGER) AS poly__degree, CAST(k AS INTEGER) AS selector__k,
                    round(mean_r2, 6) AS mean_r2,
                    CAST(row_number() OVER (ORDER BY mean_r2 DESC, a DESC, d, k) = 1 AS INTEGER) AS best
             FROM cube_grid""",
        "grid_search_linear": _with("grid")
        + f"""SELECT CAST(row_number() OVER (ORDER BY a DESC, k) - 1 AS INTEGER) AS grid_position,
                     a AS model__alpha, 1 AS poly__degree, k AS selector__k,
                     round(mean_r2, 6) AS mean_r2,
                     CAST(row_number() OVER (ORDER BY mean_r2 DESC, a DESC, k) = 1 AS INTEGER) AS best
              FROM grid""",
        "grid_search_square": _with("square_grid")
        + f"""SELECT CAST(row_number() OVER (ORDER BY a DESC, d) - 1 AS INTEGER) AS grid_position,
                     a AS model__alpha, CAST(d AS INTEGER) AS poly__degree, 1 AS selector__k,
                     round(mean_r2, 6) AS mean_r2,
                     CAST(row_number() OVER (ORDER BY mean_r2 DESC, a DESC, d) = 1 AS INTEGER) AS best
              FROM square_grid""",
        "model_fit_predict": test_predictions,
        "batch_predict": _with("predicted") + "SELECT series, Periodo, preds FROM predicted",
    }
