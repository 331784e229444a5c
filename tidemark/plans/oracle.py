"""Independent SQL formulations of the catalogue queries (DuckDB dialect).

These are written directly from the operator definitions (plain window frames,
recursive CTEs, self-joins) and share no table of weights with the Spark plans:
Gaussian weights are computed in SQL, Savitzky-Golay weights in exact rational
arithmetic here, so that agreement is a real check. Tables are the pre-registered views ``events``, ``conversations``,
``lineitem``, ``part``, ``customer``.
"""

from __future__ import annotations

from fractions import Fraction

from tidemark import config

# ---------------------------------------------------------------- sources

EV = """ev AS (
  SELECT user_id AS g, event_id AS id, ts AS ord, value AS x,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS idx,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM events)"""

NULL_EV = """ev AS (
  SELECT g, id, ts AS ord, x, row_number() OVER (PARTITION BY g ORDER BY ts, id) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n
  FROM (SELECT CASE WHEN user_id % 7 = 0 THEN -1 ELSE user_id END AS g, event_id AS id, ts, value AS x FROM events))"""

LONG_EV = """ev AS (
  SELECT 0 AS g, event_id AS id, event_id AS ord, value AS x,
         row_number() OVER (ORDER BY event_id) - 1 AS idx,
         count(*) OVER () AS n
  FROM events)"""

ORD = """ev AS (
  SELECT o_custkey AS g, o_orderkey AS id, o_totalprice AS x,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS idx,
         count(*) OVER (PARTITION BY o_custkey) AS n,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS ord
  FROM orders)"""

CONV = """ev AS (
  SELECT conv_id AS g, turn AS id, turn AS ord, CAST(length(text) AS DOUBLE) AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS idx,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM conversations)"""

W = "(PARTITION BY g ORDER BY ord"


def _shift(col: str, o: int, default: str | None = None) -> str:
    if o == 0:
        return col
    d = f", {default}" if default is not None else ""
    fn = "lead" if o > 0 else "lag"
    return f"{fn}({col}, {abs(o)}{d}) OVER {W})"


def _num(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


# ---------------------------------------------------------------- filters
# each returns an expression over the ``ev`` CTE columns (g, id, ord, x, idx, n)


def f_none(col="x"):
    return col


def f_moving_average(col="x", window=config.MA_WINDOW):
    h = window // 2
    return f"CASE WHEN n < {window} THEN {col} ELSE avg({col}) OVER {W} ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) END"


def f_moving_average_reference(col="x", window=config.MA_WINDOW):
    h = window // 2
    parts = [f"WHEN n < {window} THEN {col}", f"WHEN n < {3 * h - 1} THEN NULL"]
    for i in range(h):
        parts.append(
            f"WHEN idx = {i} THEN sum({col}) OVER {W} ROWS BETWEEN {i} PRECEDING AND {i + h} FOLLOWING) / {h + i + 1}"
        )
    parts.append(f"WHEN idx >= n - {h} THEN sum({col}) OVER {W} ROWS BETWEEN {h} PRECEDING AND UNBOUNDED FOLLOWING) / ({h} + n - idx)")
    parts.append(f"ELSE sum({col}) OVER {W} ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) / {window}")
    return "CASE " + " ".join(parts) + " END"


def f_median(col="x", kernel=config.MEDIAN_KERNEL_SIZE):
    k = kernel + (kernel + 1) % 2
    h = k // 2
    items = ", ".join(_shift(col, o, "0.0") for o in range(-h, h + 1))
    return f"CASE WHEN n < {k} THEN {col} ELSE list_sort([{items}])[{h + 1}] END"


def f_median_shrink(col="x", kernel=config.MEDIAN_KERNEL_SIZE):
    k = kernel + (kernel + 1) % 2
    h = k // 2
    return f"CASE WHEN n < {k} THEN {col} ELSE median({col}) OVER {W} ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) END"


def _hat(width: int, order: int) -> list[list[float]]:
    """Weights of the least-squares polynomial, by exact rational elimination of the
    normal equations: row r gives the fitted value at place r."""
    xs = [Fraction(i - width // 2) for i in range(width)]
    m = order + 1
    rows = [[sum(x ** (i + j) for x in xs) for j in range(m)] + [x**i for x in xs] for i in range(m)]
    for c in range(m):
        pivot = next(r for r in range(c, m) if rows[r][c] != 0)
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [v / rows[c][c] for v in rows[c]]
        for r in range(m):
            if r != c:
                f = rows[r][c]
                rows[r] = [a - f * b for a, b in zip(rows[r], rows[c])]
    return [[float(sum(x**i * rows[i][m + j] for i in range(m))) for j in range(width)] for x in xs]


def savgol_cte(name: str, window: int, src: str = "ev", col: str = "x") -> str:
    """Cubic fit by the polynomials that are orthogonal on ``window`` places, as joins."""
    h = window // 2
    return f"""gp AS (SELECT j, x, x * x - s2 / {window} AS p2, x * x * x - s4 / s2 * x AS p3, s2 FROM (
    SELECT j, (j - {h})::DOUBLE AS x, sum((j - {h})::DOUBLE ** 2) OVER () AS s2, sum((j - {h})::DOUBLE ** 4) OVER () AS s4 FROM range({window}) t(j))),
hat AS (SELECT r.j AS r, c.j AS j, 1.0 / {window} + r.x * c.x / r.s2 + r.p2 * c.p2 / (SELECT sum(p2 * p2) FROM gp) + r.p3 * c.p3 / (SELECT sum(p3 * p3) FROM gp) AS w FROM gp r, gp c),
{name} AS (SELECT a.g, a.id, CASE WHEN any_value(a.n) < {window} THEN any_value(a.{col}) ELSE sum(hat.w * b.{col}) END AS f
  FROM (SELECT *, least(greatest(idx - {h}, 0), greatest(n - {window}, 0)) AS lo FROM {src}) a JOIN hat ON hat.r = a.idx - a.lo JOIN {src} b ON b.g = a.g AND b.idx = a.lo + hat.j GROUP BY a.g, a.id)"""


def f_savgol(col="x", window=config.SG_WINDOW, polyorder=config.SG_POLYORDER):
    width = window  # the queries pass odd windows above the order, which need no repair
    hat = _hat(width, polyorder)
    h = width // 2
    branches = []
    for r in range(width):
        terms = " + ".join(f"{_num(hat[r][j])} * {_shift(col, j - r)}" for j in range(width))
        branches.append(f"WHEN {r} THEN {terms}")
    rexpr = f"(idx - least(greatest(idx - {h}, 0), n - {width}))"
    return f"CASE WHEN n < {width} THEN {col} ELSE CASE {rexpr} " + " ".join(branches) + " END END"


def gaussian_cte(name: str, src: str = "ev", col: str = "x", sigma=config.GAUSSIAN_SIGMA) -> str:
    r = int(4.0 * sigma + 0.5)
    weights = f"SELECT d, exp(-0.5 * d * d / ({sigma} * {sigma})) / sum(exp(-0.5 * d * d / ({sigma} * {sigma}))) OVER () AS w FROM range({-r}, {r + 1}) t(d)"
    m = "(((a.idx + wt.d) % (2 * a.n)) + 2 * a.n) % (2 * a.n)"
    fold = f"CASE WHEN {m} < a.n THEN {m} ELSE 2 * a.n - 1 - {m} END"
    return f"""{name} AS (
  SELECT a.g, a.id, sum(wt.w * b.{col}) AS f
  FROM {src} a, ({weights}) AS wt, {src} b
  WHERE b.g = a.g AND b.idx = {fold}
  GROUP BY a.g, a.id)"""


def kalman_cte(name: str, src: str = "ev", col: str = "x",
               q=config.KALMAN_PROCESS_VARIANCE, r=config.KALMAN_MEASUREMENT_VARIANCE) -> str:
    qv, rv = _num(q), _num(r)
    return f"""{name}_rec(g, idx, xh, p) AS (
  SELECT g, idx, {col}, CAST(1.0 AS DOUBLE) FROM {src} WHERE idx = 0
  UNION ALL
  SELECT s.g, s.idx,
         k.xh + ((k.p + {qv}) / ((k.p + {qv}) + {rv})) * (s.{col} - k.xh),
         (1 - (k.p + {qv}) / ((k.p + {qv}) + {rv})) * (k.p + {qv})
  FROM {name}_rec k JOIN {src} s ON s.g = k.g AND s.idx = k.idx + 1),
{name} AS (SELECT s.g, s.id, k.xh AS f FROM {name}_rec k JOIN {src} s ON s.g = k.g AND s.idx = k.idx)"""


WINDOW_FILTERS = {
    "none": f_none,
    "savitzky_golay": f_savgol,
    "moving_average": f_moving_average,
    "median": f_median,
}


def filter_ctes(src: str = "ev", col: str = "x", prefix: str = "") -> tuple[str, dict[str, str]]:
    """CTEs ``<prefix>f_<name>(g, id, f)`` for all six filters over ``src``."""
    ctes = []
    names = {}
    for name in config.FILTERS_TO_COMPARE:
        cte = f"{prefix}f_{name}"
        names[name] = cte
        if name in WINDOW_FILTERS:
            ctes.append(f"{cte} AS (SELECT g, id, {WINDOW_FILTERS[name](col)} AS f FROM {src})")
        elif name == "gaussian":
            ctes.append(gaussian_cte(cte, src, col))
        else:
            ctes.append(kalman_cte(cte, src, col))
    return ",\n".join(ctes), names


def long_union(names: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT g, id, '{name}' AS filter_type, {i} AS run_order, f FROM {cte}"
        for i, (name, cte) in enumerate(names.items())
    )


def with_recursive(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"
